"""Named raw sources: tables that models ask for by source and table name.

A ``RawSource`` says which tables a source has and in which schema of the
catalog they stand.  ``attach`` registers files in place under these names;
``lookup`` resolves a declared name, so that a model depends on the name and
not on where its rows come from.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ridelake.functions.sqltext import ident
from ridelake.sources.files import external_table


@dataclass(frozen=True)
class RawSource:
    """A source: its name, the catalog schema of its tables, and their names."""

    name: str
    schema: str
    tables: tuple[str, ...]

    def path(self, table: str) -> str:
        """``schema.table`` of a declared table."""
        if table not in self.tables:
            raise LookupError(f"source {self.name!r} declares no table {table!r}, only {', '.join(self.tables)}")
        return f"{ident(self.schema)}.{ident(table)}"


def attach(spark: SparkSession, source: RawSource, locations: Mapping[str, str], fmt: str = "parquet") -> None:
    """Register the files of each table in place; a table of that name is
    replaced, its files stay.  Only declared tables can be attached."""
    paths = {source.path(table): location for table, location in locations.items()}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(source.schema)}")
    for path, location in paths.items():
        external_table(spark, path, location, fmt, glob=None)


def lookup(spark: SparkSession, source: RawSource, table: str) -> DataFrame:
    """The rows of a declared table; an error that names it if the catalog has none."""
    path = source.path(table)
    if not spark.catalog.tableExists(path):
        raise LookupError(f"source {source.name!r}: {path} is declared but not in the catalog")
    return spark.table(path)


def missing(spark: SparkSession, source: RawSource) -> list[str]:
    """Declared tables that the catalog does not have."""
    return [t for t in source.tables if not spark.catalog.tableExists(source.path(t))]
