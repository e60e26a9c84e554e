"""Paged JSON source: fetch page 1, 2, ... until a page comes back empty.

A Python data source whose read work happens in executors.  The pages are
striped over ``partitions`` input partitions: partition ``i`` fetches pages
``start + i``, ``start + i + n``, ... and stops at its first empty page, which
it reports.  ``read_pages`` keeps what was fetched in the shared folder (a lost
executor fetches nothing again) and drops what lies beyond the first empty
page of all stripes.  One Arrow batch a page.

Options:
  url         page address with a ``{page}`` placeholder; ``http(s)://``
              is fetched with a GET returning a JSON list, anything else is
              a folder of JSON-lines files (the test double of the API)
  start_page  first page (default 1)
  end_page    last page to fetch at most (optional)
  partitions  number of stripes (by default the cores of the cluster)
  known       of a stream: no page before this one is asked for when the last
              page is looked up (default: start_page)
The schema must be given with ``.schema(...)``.

As a stream, the source's offset is the number of the next page to fetch.  The
end of a batch is found by doubling steps and halving, so a list that grew by n
pages is asked for about 2 log n of them on the driver; the pages themselves
are fetched in executors.  A page is taken once, when it is first seen: pages
must not change after that, as in any list that is only appended to.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader,
                                    InputPartition)

from ridelake.session import scratch_path

#: Column that numbers the page of a row.
PAGE = "_page"


class _Stripe(InputPartition):
    def __init__(self, index: int, count: int):
        self.index = index
        self.count = count


def _fetch(url_template: str, page: int) -> list[dict]:
    url = url_template.format(page=page)
    if url.startswith(("http://", "https://")):
        import urllib.request

        with urllib.request.urlopen(url, timeout=60) as resp:  # noqa: S310
            data = json.loads(resp.read().decode("utf-8"))
        return list(data or [])
    # a folder of JSON-lines files on any pyarrow file system (local,
    # HDFS, object stores): the shared scratch folder on a cluster
    import pyarrow.fs as pafs

    norm = "file:///" + url[len("file:"):].lstrip("/") if url.startswith("file:") else url
    filesystem, folder = pafs.FileSystem.from_uri(norm)
    info = filesystem.get_file_info(folder)
    if info.type != pafs.FileType.Directory:
        return []
    names = sorted(f.path for f in filesystem.get_file_info(pafs.FileSelector(folder))
                   if f.type == pafs.FileType.File and f.path.endswith(".json"))
    records: list[dict] = []
    for name in names:
        with filesystem.open_input_stream(name) as fh:
            text = fh.read().decode("utf-8")
        records.extend(json.loads(line) for line in text.splitlines() if line.strip())
    return records


def _converter(type_name: str):
    if type_name.startswith("timestamp"):
        return lambda v: None if v is None else dt.datetime.fromisoformat(
            str(v).replace("Z", "").replace("T", " ")[:26])
    if type_name == "date":
        return lambda v: None if v is None else dt.date.fromisoformat(str(v)[:10])
    if type_name in ("bigint", "int", "smallint", "tinyint"):
        return lambda v: None if v is None else int(v)
    if type_name in ("double", "float"):
        return lambda v: None if v is None else float(v)
    return lambda v: v


class PagedJsonReader(DataSourceReader):
    def __init__(self, options, schema):
        self.url = options["url"]
        self.start = int(options.get("start_page", 1))
        self.end = int(options["end_page"]) if options.get("end_page") else None
        self.n = max(1, int(options.get("partitions", 4)))
        self.fields = [(f.name, _converter(f.dataType.simpleString())) for f in schema.fields
                       if f.name != PAGE]
        self.spark_schema = schema

    def partitions(self):
        return [_Stripe(i, self.n) for i in range(self.n)]

    def read(self, partition):
        page = self.start + partition.index
        while self.end is None or page <= self.end:
            records = _fetch(self.url, page)
            # an empty page is one row without values, under its negative number
            yield self.batch(records or [{}], page if records else -page)
            if not records:
                break
            page += partition.count

    def batch(self, records: list[dict], page: int):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.spark_schema)
        columns = {name: [conv(r.get(name)) for r in records] for name, conv in self.fields}
        columns[PAGE] = [page] * len(records)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema],
                                          schema=schema)


class _Pages(InputPartition):
    def __init__(self, first: int, end: int, step: int):
        self.first = first
        self.end = end
        self.step = step


class PagedJsonStreamReader(DataSourceStreamReader):
    def __init__(self, options, schema):
        self.pages = PagedJsonReader(options, schema)
        self.known = max(self.pages.start, int(options.get("known", self.pages.start)))

    def initialOffset(self):
        return {"page": self.pages.start}

    def latestOffset(self):
        """The first page that is missing or beyond ``end_page``."""
        if not self._there(self.known):
            return {"page": self.known}
        step = 1
        while self._there(self.known + step):
            step *= 2
        there, missing = self.known + step // 2, self.known + step
        while missing - there > 1:
            middle = (there + missing) // 2
            there, missing = (middle, missing) if self._there(middle) else (there, middle)
        self.known = missing
        return {"page": missing}

    def _there(self, page: int) -> bool:
        return (self.pages.end is None or page <= self.pages.end) and bool(_fetch(self.pages.url, page))

    def partitions(self, start, end):
        n = min(self.pages.n, end["page"] - start["page"])
        return [_Pages(start["page"] + i, end["page"], n) for i in range(n)]

    def read(self, partition):
        for page in range(partition.first, partition.end, partition.step):
            records = _fetch(self.pages.url, page)
            if not records:
                raise ValueError(f"page {page} is empty, but a later one is not")
            yield self.pages.batch(records, page)


class PagedJsonDataSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        raise ValueError("paged_json needs a declared schema: .schema('a int, b string')")

    def reader(self, schema):
        return PagedJsonReader(self.options, schema)

    def streamReader(self, schema):
        return PagedJsonStreamReader(self.options, schema)


def register(spark) -> None:
    spark.dataSource.register(PagedJsonDataSource)


def read_pages(spark, url: str, schema: str, partitions: int | None = None, start_page: int = 1,
               end_page: int | None = None):
    register(spark)
    reader = (spark.read.format("paged_json").schema(f"{schema}, {PAGE} bigint")
              .option("url", url)
              .option("partitions", partitions or spark.sparkContext.defaultParallelism)
              .option("start_page", start_page))
    if end_page is not None:
        reader = reader.option("end_page", end_page)
    path = scratch_path(spark, "paged")
    reader.load().write.parquet(path)
    rows = spark.read.parquet(path)
    last = rows.where(F.col(PAGE) < 0).agg(F.max(PAGE)).first()[0]
    kept = rows.where(F.col(PAGE) >= 0) if last is None else rows.where(F.col(PAGE).between(0, -last - 1))
    return kept.drop(PAGE)
