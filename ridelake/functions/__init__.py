"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from ridelake.functions.keys import surrogate_key  # noqa: F401
from ridelake.functions.time import (  # noqa: F401
    hours_between,
    in_window,
    month_start,
    on_day,
    parse_day,
)
