"""Byte-level BPE, fill-in-the-middle and the Merkle manifest against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_rows, empty, frame
from pyspark.sql import functions as F

from ridelake.llm import byte_bpe as bpe
from ridelake.llm import fill_middle as fim
from ridelake.llm import merkle
from ridelake.llm.byte_bpe import op11_byte_bpe
from ridelake.llm.fill_middle import op12_fill_in_middle
from ridelake.llm.merkle import op13_merkle_manifest
from ridelake.llm.tokens import public_path

HOW = public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LETTERS = st.text(alphabet="ab1٣'s!、的é \n\t 　\x1c\x85", max_size=40)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """A folder whose documents hold every odd case, with columns that clash."""
    path = str(tmp_path_factory.mktemp("docs"))
    rows = edge_rows() + [(20 + i, t) for i, t in enumerate(["a <P> b\nc", "no end\n\n", "\n", "ends\n", " " * 9000 + "x"])]
    names = ["tree", "rank", "n", "digest", "block", "id", "ids", "decoded", "form", "output", "h1", "_in", "_salt"]
    df = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 9, "de").when(F.col("doc_id") < 16, "en"))
    df.withColumns({c: F.lit(2) for c in names}).write.parquet(f"{path}/documents.parquet")
    return path, [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


# ------------------------------------------------------------------- byte-level BPE

def plain_ids(text, ranks, pattern):
    """The merges by the definition: the pair of least rank first."""
    out = []
    for match in regex.findall(pattern, text):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (ranks.get(parts[i] + parts[i + 1], 1 << 30), i))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        out += [ranks[p] for p in parts]
    return out


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_are_those_of_plain_merges():
    b = bpe.byte_bpe(*HOW)
    ranks = {k: v for k, v in b.by_match._mergeable_ranks.items()}
    for text in [t or "" for _, t in edge_rows() if len(t or "") < 2000] + ["it's we'll <|endoftext|> 1٣½ é　 x\n\n y"]:
        assert ids_of(b.encode(text)) == plain_ids(text, ranks, HOW[1])
        assert b.decode(b.encode(text)) == text.encode()


@settings(max_examples=400, deadline=None)
@given(LETTERS, st.integers(1, 6))
def test_cuts_change_no_match(text, size):
    b = bpe.byte_bpe(*HOW)
    whole = b.by_match.encode_ordinary(text)
    run, long = bpe.LONG_RUN, bpe._LONG
    bpe.LONG_RUN, bpe._LONG = 2, re.compile(f"[{bpe.WHITE}]{{3,}}")
    try:
        parts = list(bpe.segments(text, size))
    finally:
        bpe.LONG_RUN, bpe._LONG = run, long
    assert "".join(p for p, _ in parts) == text
    ids = [i for p, single in parts for i in (b.as_match if single else b.by_match).encode_ordinary(p)]
    assert ids == whole


def test_white_space_is_the_patterns():
    white = "".join(c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and regex.fullmatch(r"\s", c))
    assert "".join(re.findall(f"[{bpe.WHITE}]", "".join(map(chr, range(0xD800))))) == white


def test_very_long_texts():
    b = bpe.byte_bpe(*HOW)
    space, word = " " * 3_000_000, "ab" * 200_000
    for text in [space, "x" + space + "y", "\n" * 2_000_000 + "z", word + "," + space, "的" * 150_000 + "。x"]:
        assert b.decode(b.encode(text)) == text.encode()
    # one match for all but the last character, which the next match begins with
    assert ids_of(b.encode("x" + space + "y")) == (
        b.by_match.encode_ordinary("x") + b.as_match.encode_ordinary(space[:-1]) + b.by_match.encode_ordinary(" y"))


def test_unknown_ids_and_names():
    b = bpe.byte_bpe(*HOW)
    with pytest.raises(KeyError):
        b.decode(np.array([1 << 30], "<u4").tobytes())
    assert b.decode(b"") == b""


def test_byte_bpe_query(spark, documents):
    path, rows = documents
    b = bpe.byte_bpe(*HOW)
    want = []
    for doc, *_, text in rows:
        ids = b.encode(text or "")
        want.append((doc, len(ids) // 4, sha(ids), sha((text or "").encode())))
    got = [tuple(r) for r in op11_byte_bpe(spark, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encode(empty(spark), *HOW).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(empty(spark).withColumn("ids", F.lit(1)), *HOW, keep=("ids",))


def test_kept_columns_with_odd_names(spark):
    df = frame(spark, [(1, "x y")]).withColumn("a.b", F.lit(5))
    assert tuple(bpe.encode(df, *HOW, keep=("doc_id", "a.b")).first())[:2] == (1, 5)


# ------------------------------------------------------------------- fill in the middle

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300))
def test_skip_list_finds_every_rank(lengths):
    units = fim.SkipList(np.array(lengths, np.int64))
    sums = np.append(0, np.cumsum(np.array(lengths, np.int64)))
    assert [units.seek(r) for r in range(len(lengths) + 1)] == sums.tolist()
    with pytest.raises(IndexError):
        units.seek(len(lengths) + 1)


def test_express_lanes_shorten_the_way():
    units = fim.SkipList(np.arange(100_000))
    sizes = [len(u) for u, _ in units.lanes]
    assert len(sizes) > 5 and all(b < a * 0.4 for a, b in zip(sizes, sizes[1:]) if a > 100)
    for u, c in units.lanes:  # widths of a lane are those of the lanes below
        assert (u.sum(), c.sum()) == (u.sum(), np.arange(u.sum()).sum())


def plain_example(doc, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"7:{'' if doc is None else doc}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc, n, form, len(p), len(m), sha(out), sha(text)


def test_fill_in_middle_query(spark, documents):
    path, rows = documents
    got = [tuple(r) for r in op12_fill_in_middle(spark, path).collect()]
    assert sorted(got, key=str) == sorted((plain_example(r[0], r[-1]) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(empty(spark), 7).count() == 0


def test_fill_in_middle_parameters(spark):
    rows = [(i, f"w{i}<\nS> x\n<y" * (i % 4)) for i in range(60)]
    df = frame(spark, rows)
    made = fim.fill_in_middle(df, 7, unit=r"(?s).", rate=40, marks=("<<", "[S]", "\\Q|"))
    got = {r.doc_id: r for r in made.withColumn("back", fim.restored(
        F.col("output"), F.col("form"), ("<<", "[S]", "\\Q|"))).collect()}
    assert all(got[i].back == t and got[i].n == len(t) for i, t in rows)
    forms = [got[i].form for i, t in rows if t]
    assert 0 < sum(f != "plain" for f in forms) < len(forms)
    with pytest.raises(ValueError):
        fim.fill_in_middle(df, 7, marks=("<P>", "<P>", "<M>"))
    with pytest.raises(Exception, match="do not cover"):
        fim.fill_in_middle(df, 7, unit="[a-z]").collect()


# ------------------------------------------------------------------- Merkle manifest

def row_leaf(values):
    def text(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return sha("".join(map(text, values)))


def climb(nodes):
    """Levels of a tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def route(out, index):
    """(digests before, digests after) a level."""
    path = []
    for level in out[:-1]:
        run = index - index % 8
        path.append(("".join(level[run:index]), "".join(level[index + 1:run + 8])))
        index //= 8
    return path


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> the query's rows."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, row_leaf(r), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: climb([x[2] for x in sorted(by_lang[k], key=lambda x: x[:3])]) for k in langs}
    top, out = climb([trees[k][-1][0] for k in langs]), []
    for at, k in enumerate(langs):
        for i, (*_, own, r) in enumerate(sorted(by_lang[k], key=lambda x: x[:3])):
            path = route(trees[k], i) + route(top, at)
            folded = own
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                folded = row_leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in path)),
                        folded, folded == top[-1][0]))
    return out


def test_positions_are_the_completion_order():
    for n in [*range(1, 75), 511, 512, 513, 600]:
        top, log = merkle.levels(n), []
        leaves = [sha(str(i)) for i in range(n)]
        log = merkle.segment(leaves, top)
        levels = climb(leaves)
        assert len(levels) == top + 1 and len(log) == sum(map(len, levels))
        for level, nodes in enumerate(levels):
            for i, digest in enumerate(nodes):
                assert log[merkle.position(level, i, n, top)] == digest
        before, after = merkle.siblings(log, n // 2, n, top)
        assert list(zip(before, after)) == route(levels, n // 2)
        assert merkle.fold(leaves[n // 2], before, after) == log[-1]


def test_manifest_query(spark, documents):
    path, rows = documents
    got = [tuple(r) for r in op13_merkle_manifest(spark, path).collect()]
    want = plain_manifest(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[-1] for r in got} == {True, False}


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def test_manifest_of_several_rounds(spark):
    """More leaves than a builder takes, a tree of one leaf, many equal rows."""
    rng = random.Random(3)
    rows = [(rng.randrange(900), "T" + rng.choice("ab"), rng.choice([None, "", "big"]) if i > 700 else "big") for i in range(1500)]
    rows += [(5, "same", "big")] * 700 + [(1, "Alone", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"source": F.lit(None).cast("string"), "n_chars": F.lit(1)})
    m = merkle.manifest(df, COLUMNS, "lang", "doc_id", {"changed": F.lit(None).cast("binary")})
    assert len(m.rounds) == 2 and [r.n for r in m.trees.collect()] == [4] * 4
    schema = "tree string, doc_id long, digest binary, proof_sha256 string, folded_root string"
    got = merkle.proofs(m, schema, merkle._verified).select("doc_id", F.lower(F.hex("digest")), "proof_sha256").collect()
    full = [(d, None, lang, 1, t) for d, t, lang in rows]
    assert sorted(map(tuple, got)) == sorted((r[0], r[1], r[4]) for r in plain_manifest(full))
    # the log: every node once, in the order of an append-only builder of the whole tree
    listed = {}
    for r in merkle.node_list(m.rounds).collect():
        listed.setdefault(r.tree, []).append((r.position, r.level, r.index, r.digest.hex()))
    by_lang = {}
    for r in full:
        by_lang.setdefault("-" if r[2] is None else "=" + r[2], []).append((r[0], row_leaf(r)))
    for tree, leaves in by_lang.items():
        log = merkle.segment([d for _, d in sorted(leaves)], merkle.levels(len(leaves)))
        assert [x[0] for x in sorted(listed[tree])] == list(range(len(log)))
        assert [x[3] for x in sorted(listed[tree])] == log


def test_manifest_of_nothing(spark):
    m = merkle.manifest(empty(spark), COLUMNS, "lang", "doc_id")
    assert m.leaves.count() == 0 and merkle.roots(m.top).count() == 0 and merkle.node_list(m.rounds).count() == 0
    schema = "tree string, rank long, before array<string>, after array<string>"
    assert merkle.proofs(m, schema, merkle._plain).count() == 0
