"""Paged JSON source as a checkpointed stream: a run takes the new pages only."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridelake.sources import fs
from ridelake.sources.paged import PAGE, register
from ridelake.streaming.ingest import _run


def next_page(spark: SparkSession, checkpoint: str) -> int | None:
    """The page that the next batch of a checkpoint starts with; None before
    the first batch."""
    planned = [int(n) for n in fs.list_names(spark, f"{checkpoint}/offsets") if n.isdigit()]
    if not planned:
        return None
    lines = spark.read.text(f"{checkpoint}/offsets/{max(planned)}").collect()  # three lines
    return next(entry["page"] for (line,) in lines if line.startswith("{")
                for entry in [json.loads(line)] if "page" in entry)


def read_new_pages(spark: SparkSession, url: str, schema: str, out_dir: str, checkpoint: str,
                   partitions: int | None = None, start_page: int = 1,
                   end_page: int | None = None) -> StreamingQuery:
    """Append the rows of every page that no earlier run has taken to parquet
    in ``out_dir``, each with the number of its page in ``_page``.

    ``url`` and ``schema`` as for ``paged.read_pages``.  The list ends before
    its first missing page when only the end of the list is missing; a hole (an
    empty page with later ones behind it that the search happened on) fails the
    run, and the next one starts at the same page.  The sink's log commits a
    batch as a whole, so a run that died leaves no row twice; the next run
    finishes its batch, and the one after that takes newer pages."""
    register(spark)
    reader = (spark.readStream.format("paged_json").schema(f"{schema}, {PAGE} bigint")
              .option("url", url).option("start_page", start_page)
              .option("partitions", partitions or spark.sparkContext.defaultParallelism)
              .option("known", next_page(spark, checkpoint) or start_page))
    if end_page is not None:
        reader = reader.option("end_page", end_page)
    return _run(reader.load().writeStream.format("parquet").outputMode("append"), checkpoint, out_dir)
