"""CSV files to parquet as a checkpointed file stream.

The checkpoint's file log knows what is done, by whole path, so nothing is
listed or compared on the driver; finished files can be archived or deleted by
the stream itself, after the batch that read them is committed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ridelake.sources import fs
from ridelake.streaming.ingest import _run

#: No file is too old to be new: the source otherwise skips files that are a
#: week older than the newest it has seen.
ANY_AGE = "36500d"


def csv_stream_to_parquet(spark: SparkSession, inputs: str, out_dir: str, checkpoint: str, schema: StructType,
                          archive_dir: str | None = None, delete: bool = False,
                          max_files: int | None = None) -> StreamingQuery:
    """Convert every CSV(.gz) below ``inputs`` that no earlier run has taken
    into parquet below ``out_dir/source=<path below inputs, without the
    ending>``.

    Files have a header and the columns of ``schema``.  A finished file is left
    where it is, moved below ``archive_dir`` (outside ``inputs``) under its own
    path, or deleted.  The sink's log commits a batch as a whole: a run that
    died is finished by the next one without repeated rows.  ``max_files``
    bounds a batch."""
    if delete and archive_dir:
        raise ValueError("finished files are archived or deleted, not both")
    root = fs.plain_path(spark, inputs).rstrip("/") + "/"
    reader = (spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.{csv,csv.gz}").option("maxFileAge", ANY_AGE))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        archive = fs.plain_path(spark, archive_dir).rstrip("/") + "/"
        if archive.startswith(root) or root.startswith(archive):
            raise ValueError("the archive must lie outside the inputs")
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    # file paths come percent-encoded
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    rows = reader.csv(inputs).withColumn(
        "source", F.regexp_replace(F.substring_index(path, root, -1), r"\.csv(\.gz)?$", ""))
    return _run(rows.writeStream.format("parquet").partitionBy("source").outputMode("append"), checkpoint, out_dir)
