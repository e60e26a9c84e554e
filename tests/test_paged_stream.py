"""The paged source as a stream: new pages only, no row twice, holes."""

import json
import os

import pytest

from ridelake.session import scratch_path
from ridelake.sources.paged import PagedJsonStreamReader, _fetch
from ridelake.streaming import pages

SCHEMA = "id bigint, name string"


def _serve(folder, numbers):
    for p in numbers:
        d = os.path.join(folder, f"page={p}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "part-0.json"), "w") as fh:
            for i in range(3):
                fh.write(json.dumps({"id": p * 10 + i, "name": None if i else f"n{p}"}) + "\n")


def _ids(numbers):
    return sorted(p * 10 + i for p in numbers for i in range(3))


def _run(spark, folder, out, ckpt, **options):
    query = pages.read_new_pages(spark, folder + "/page={page}", SCHEMA, out, ckpt, **options)
    found = sorted(r.id for r in spark.read.schema(SCHEMA).parquet(out).collect())
    return sum(p["numInputRows"] for p in query.recentProgress), found


def test_a_run_takes_new_pages_only(spark, tmp_path):
    out, ckpt = (scratch_path(spark, n) for n in ("pg-out", "pg-ckpt"))
    folder = str(tmp_path)
    assert pages.next_page(spark, ckpt) is None
    _serve(folder, range(1, 5))
    assert _run(spark, folder, out, ckpt, partitions=3) == (12, _ids(range(1, 5)))
    assert pages.next_page(spark, ckpt) == 5
    _serve(folder, range(5, 16))
    assert _run(spark, folder, out, ckpt, partitions=4) == (33, _ids(range(1, 16)))
    assert _run(spark, folder, out, ckpt) == (0, _ids(range(1, 16)))  # nothing new
    got = spark.read.parquet(out).selectExpr("id", "_page").collect()
    assert all(r.id // 10 == r._page for r in got)


def test_a_batch_that_was_not_committed_is_read_again(spark, tmp_path):
    out, ckpt = (scratch_path(spark, n) for n in ("pr-out", "pr-ckpt"))
    folder = str(tmp_path)
    for upto in (3, 7):
        _serve(folder, range(1, upto))
        _run(spark, folder, out, ckpt)
    commits = os.path.join(ckpt.removeprefix("file:"), "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    _serve(folder, range(7, 9))
    assert _run(spark, folder, out, ckpt)[1] == _ids(range(1, 7))  # finishes the batch
    assert _run(spark, folder, out, ckpt) == (6, _ids(range(1, 9)))


def test_first_page_last_page_and_no_pages(spark, tmp_path):
    out, ckpt = (scratch_path(spark, n) for n in ("pe-out", "pe-ckpt"))
    folder = str(tmp_path)
    assert _run(spark, folder, out, ckpt, start_page=3) == (0, [])
    _serve(folder, range(1, 9))
    assert _run(spark, folder, out, ckpt, start_page=3, end_page=6) == (12, _ids(range(3, 7)))
    assert _run(spark, folder, out, ckpt, start_page=3) == (6, _ids(range(3, 9)))


def test_a_hole_fails_the_run_and_loses_nothing(spark, tmp_path):
    out, ckpt = (scratch_path(spark, n) for n in ("ph-out", "ph-ckpt"))
    folder = str(tmp_path)
    _serve(folder, [1, 3, 5])  # the search asks for 1 and 2
    assert _run(spark, folder, out, ckpt) == (3, _ids([1]))
    _serve(folder, [2])  # now for 2, 3, 4
    assert _run(spark, folder, out, ckpt) == (6, _ids(range(1, 4)))
    _serve(folder, [4, 5, 6, 8])  # 4, 5, 6, 8, and 7 is missing
    with pytest.raises(Exception, match="page 7 is empty"):
        _run(spark, folder, out, ckpt)
    _serve(folder, [7])
    assert _run(spark, folder, out, ckpt)[1] == _ids(range(1, 9))


@pytest.mark.parametrize("pages_there", [0, 1, 2, 3, 7, 8, 9, 100])
@pytest.mark.parametrize("known", [1, 2, 5])
def test_the_end_is_found_in_few_requests(monkeypatch, spark, pages_there, known):
    asked = []

    def fetch(url, page):
        asked.append(page)
        return [{"id": page}] if page <= pages_there else []

    monkeypatch.setattr("ridelake.sources.paged._fetch", fetch)
    reader = PagedJsonStreamReader({"url": "x", "known": str(known)},
                                   spark.createDataFrame([], SCHEMA).schema)
    assert reader.latestOffset() == {"page": max(known, pages_there + 1)}
    assert len(asked) <= 2 * max(1, pages_there - known + 2).bit_length() + 1


def test_missing_folder_is_an_empty_page(tmp_path):
    assert _fetch(str(tmp_path) + "/page={page}", 1) == []
