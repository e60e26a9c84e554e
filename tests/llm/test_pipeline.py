import random

import __spark_entry__ as entry
from llm_fixtures import brute_substrings, by_text, edge_rows, frame, prose

import corpus_pipeline as cp


def test_registered():
    keys = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in keys) for n in range(1, 11)) and "pipeline" in keys
    assert [f for _, f in cp.STAGES] == [cp.quality, cp.near_dedup, cp.substring_dedup, cp.decontaminate, cp.pack]


def test_oracles(spark):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(entry.__file__).parent / "tools"))
    from oracle_check import compare, duck_connect

    from ridelake.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    for key, sql in ORACLE.items():
        res = compare(spark, key, QUERIES[key], sql, sf, duck_connect(sf))
        assert res["status"] == "match", res


def test_middle_stages_match_brute_force(spark, tmp_path):
    rng = random.Random(21)
    vocabulary = [f"v{i}" for i in range(900)]
    leak = prose(rng, 30, vocabulary)
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, prose(rng, 150, vocabulary)) for i in range(30)]
    rows += [(30 + i, rows[i][1]) for i in range(5)]  # exact copies
    rows += [(40, rows[7][1].replace(rows[7][1].split()[75], "other"))]
    passage = prose(rng, 60, vocabulary)
    rows += [(50 + i, prose(rng, 80, vocabulary) + " " + passage) for i in range(3)]
    rows += [(60, prose(rng, 60, vocabulary) + " " + leak)]
    docs = frame(spark, rows, clash=False)
    kept = cp.near_dedup(spark, docs, str(tmp_path))
    ids = sorted(r.doc_id for r in kept.collect())
    assert not set(range(30, 35)) & set(ids) and set(range(30)) <= set(ids)
    cut = cp.substring_dedup(spark, kept, str(tmp_path))
    texts = {r.doc_id: r.text for r in cut.collect()}
    left = {d: n - gone for d, n, gone, _, _ in brute_substrings([r for r in rows if r[0] in ids])}
    assert {d: len(t.encode()) for d, t in texts.items()} == {d: n for d, n in left.items() if n}
    assert passage in texts[50] and passage not in texts[51]
    clean = cp.decontaminate(spark, cut, str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(texts) - {60})
    assert clean.columns == list(cp.COLUMNS)


def test_edge_documents_pass_all_stages(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rng, vocabulary = random.Random(3), [f"v{i}" for i in range(900)]
    clean = [(1000 + i, prose(rng, 100, vocabulary)) for i in range(100)]
    for rows in (edge_rows() + clean, []):
        frame(spark, rows or edge_rows()).where("1 = 1" if rows else "1 = 0") \
            .write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        kept = {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()}
        assert kept >= {d for d, _ in clean} if rows else not kept


def test_decontamination_judges_rows(spark, tmp_path):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(900)]
    leak = prose(rng, 30, vocabulary)
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(d, prose(rng, 60, vocabulary)) for d in (None, None, None, 1, 1, 2)] + [(None, None), (3, "")]
    dirty = [(d, prose(rng, 20, vocabulary) + " " + leak) for d in (None, 1, 4)]
    docs = frame(spark, clean + dirty + dirty[:1], clash=False)
    got = cp.decontaminate(spark, docs, str(tmp_path))
    assert by_text((r.doc_id, r.text) for r in got.collect()) == by_text(clean)


def test_near_dedup_keeps_one_row_of_each_group(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(900)]
    a, b, c, d, e, f = (prose(rng, 150, vocabulary) for _ in range(6))
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (None, c), (3, d), (3, d), (None, d),
            (None, e), (None, f), (None, a)]
    got = cp.near_dedup(spark, frame(spark, rows, clash=False), str(tmp_path))
    assert got.columns == list(cp.COLUMNS)
    assert by_text((r.doc_id, r.text) for r in got.collect()) == by_text(
        [(1, a), (1, b), (None, c), (3, d), (None, e), (None, f)])
