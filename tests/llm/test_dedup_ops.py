import random

import numpy as np
import xxhash
from llm_fixtures import SPACE, brute_substrings, by_text, edge_rows, empty, frame, low, prose

from ridelake.llm import simhash, suffix_dedup
from ridelake.llm.components import components


def brute_simhash(text):
    w = SPACE.findall(low(text))
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < 4 else [" ".join(w[i:i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, max_bits=4):
    """fingerprint -> smallest fingerprint reachable."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= max_bits:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


def test_fingerprints_and_groups_match_brute_force(spark):
    rng = random.Random(3)
    base = prose(rng, 200).split()
    rows = edge_rows()
    for i in range(60):
        w = list(base)
        w[rng.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w)))
    fps = [(d, brute_simhash(t)) for d, t in rows]
    group = brute_groups([f for _, f in fps])
    least = {}
    for d, f in fps:
        if d is not None:
            least[group[f]] = min(d, least.get(group[f], d))
    want = by_text((d, f"{f:016x}", least.get(group[f])) for d, f in fps)
    for max_cell in (4096, 4):  # the second deals hot cells out in chunks
        got = simhash.near_duplicates(frame(spark, rows), max_cell=max_cell)
        assert by_text(got.collect()) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_grid_join_loses_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64).astype(np.uint64)
    near = []
    for f in base:
        for _ in range(6):
            g = int(f)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                g ^= 1 << int(bit)
            near.append(g)
    fps = sorted({int(f) for f in base} | set(near))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for max_bits, blocks in ((4, 8), (3, 6), (0, 4)):
        links = [(r.a % (1 << 64), r.b % (1 << 64))
                 for r in simhash.linked_fingerprints(df, max_bits, blocks, max_cell=16).collect()]
        assert all(bin(a ^ b).count("1") <= max_bits for a, b in links)
        up = {f: f for f in fps}

        def root(f):
            while up[f] != f:
                f = up[f]
            return f

        for a, b in links:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
        assert {f: root(f) for f in fps} == brute_groups(fps, max_bits)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[200 + i] == 100 for i in range(50))


def test_repeated_and_null_ids_follow_one_another(spark):
    text = prose(random.Random(4), 40)
    rows = [(None, text), (3, text), (3, text), (1, text[:150])]
    got = by_text((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect())
    size = len(text.encode())
    assert got == [(None, 0), (1, len(text[:150].encode())), (3, size), (3, size)]


def test_unique_ids_match_brute_force(spark):
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows())]
    rows[4] = (4, rows[4][1][:6000])
    rng = random.Random(9)
    for _ in range(60):
        t, s = rng.choice(rows)[1] or "", rng.randrange(300)
        rows.append((len(rows), prose(rng, rng.randrange(30)) + t[s:s + rng.randrange(80, 400)] + prose(rng, 5)))
    for max_group in (100_000, 2):
        got = suffix_dedup.remove_repeats(frame(spark, rows), max_group=max_group)
        assert by_text(got.collect()) == by_text(brute_substrings(rows))
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_text_longer_than_a_segment(spark):
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefghij ") for _ in range(300_000))
    rows = [(0, a), (1, a[1000:1100] + "#" + a[131_000:131_300]), (2, "%" + a[262_100:262_250])]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == {0: 0, 1: 400, 2: 150}


def test_kept_text_is_what_was_hashed(spark):
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows()) if i != 4]
    kept = suffix_dedup.remove_repeats(frame(spark, rows), keep=("doc_id", "text", "lang")).collect()
    assert {r.lang for r in kept} == {"en"}
    for r in kept:
        assert len((r.text or "").encode()) in range(r.n_bytes - r.n_removed - 6, r.n_bytes - r.n_removed + 1)


def test_components_by_rounds_and_in_one_task_agree(spark):
    from ridelake.llm.components import components, settled

    rng = random.Random(2)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(330)] + [(i, i + 1) for i in range(900, 960)]
    edges += [(7, 7), (1 << 62, -(1 << 62))]
    least = {}
    for a, b in edges:
        least.setdefault(a, a), least.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    want = sorted((n, r) for n, r in least.items() if n not in loops)
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, components(df).collect())) == want
    # stars name every node but the roots
    assert sorted(map(tuple, components(df, few=0).collect())) == [(n, r) for n, r in want if n != r]
    assert components(df.where("1 = 0")).count() == 0
    nodes, roots = settled(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(nodes) == len(roots) == 0
