"""Parquet footers read by executors.

Spark's file index lists the files and ``mapInPandas`` opens each file's
footer in a task, so metadata work is spread over the cluster instead of
running file by file on the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SPARK_SCHEMA_KEY = b"org.apache.spark.sql.parquet.row.metadata"


def _open(uri: str):
    import pyarrow.fs as pafs

    norm = "file:///" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri
    filesystem, rel = pafs.FileSystem.from_uri(norm)
    return filesystem.open_input_file(rel)


def _schemas(batches):
    import pandas as pd
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    for pdf in batches:
        out = []
        for uri in pdf["path"]:
            with _open(uri) as fh:
                arrow = pq.read_schema(fh)
            meta = arrow.metadata or {}
            if _SPARK_SCHEMA_KEY in meta:
                text = meta[_SPARK_SCHEMA_KEY].decode("utf-8")
            else:
                text = from_arrow_schema(arrow, prefer_timestamp_ntz=True).json()
            out.append((uri, text))
        yield pd.DataFrame(out, columns=["path", "schema_json"])


def schema_groups(spark: SparkSession, folders: list[str]) -> list[tuple[StructType, list[str]]]:
    """The parquet files below ``folders`` by the schema in their own footer
    (the schema Spark wrote, or the one derived from the parquet types).

    Spark lists the files; footers are read and grouped by executors, and one
    row a schema comes back, with the paths that a scan of it needs.  Groups
    and their files are in the order of the paths."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.parquet").load(folders).select("path"))
    found = (listed.mapInPandas(_schemas, "path string, schema_json string")
             .groupBy("schema_json").agg(F.sort_array(F.collect_list("path")).alias("paths")))
    groups = [(StructType.fromJson(json.loads(r["schema_json"])), list(r["paths"])) for r in found.collect()]
    return sorted(groups, key=lambda g: g[1][0])
