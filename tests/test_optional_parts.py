"""The library without its optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ASK = """
import __spark_entry__ as e
from ridelake.session import build_session
keys, sql = set(e.queries()), set(e.oracle_sql())
assert "pipeline" not in keys and not [k for k in keys if k.startswith("op")], keys
assert sql == keys, sql ^ keys
spark = build_session("local[2]", 2)
print("rows", e.queries()["short_trip_count"](spark, {sf!r}).count())
spark.stop()
"""


@pytest.mark.parametrize("gone", [["ridelake/llm", "tests/llm"], ["ridelake/llm", "tests/llm", "corpus_pipeline.py"]])
def test_queries_without_the_subpackage(tmp_path, sf_dir, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *(os.path.basename(g) for g in gone)))
    assert not any((copy / g).exists() for g in gone)
    run = subprocess.run([sys.executable, "-c", ASK.format(sf=sf_dir)], cwd=copy, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(copy)}, timeout=300)
    assert run.returncode == 0 and "rows 1" in run.stdout, run.stderr[-2000:]
