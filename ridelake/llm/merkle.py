"""Merkle manifest of a dataset: a hash tree a group, and one over the groups.

A tree's nodes are kept in the order in which an append-only builder completes
them (postorder).  With runs of ``WAYS`` children the place of a node in that
order is closed form: the node of a level that ends before leaf ``e`` follows
ceil(e / WAYS^l) nodes of each level l up to its own and floor((e - 1) /
WAYS^l) of each level above (``position``).

At scale a builder takes an aligned run of WAYS^HEIGHT nodes, a subtree that
stands in one piece of the order, and appends its segment: 32-byte digests,
one after the other.  The roots of these subtrees are the leaves of the next
round, until a tree has one node.  Proofs are read downwards: a builder's
leaves find their siblings in its segment by position, and share the siblings
of all levels above, which arrive as one row a segment.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import UPPER, prepare, staged, table

WAYS = 8
#: Levels that one builder completes: at most 512 leaves.
HEIGHT = 3
#: Rows of the numbering table up to which it is sent to all tasks (below 50 MB).
SMALL_ROWS = 200_000


def levels(n: int) -> int:
    """Levels above the leaves of a tree."""
    h = 0
    while n > 1:
        n, h = -(-n // WAYS), h + 1
    return h


@lru_cache(1 << 14)
def position(level: int, index: int, n: int, top: int) -> int:
    """Place in completion order, from 0, of a node of a tree with ``n`` leaves
    and ``top`` levels above them."""
    end = min((index + 1) * WAYS ** level, n)
    return (sum(-(-end // WAYS ** l) for l in range(level + 1))
            + sum((end - 1) // WAYS ** l for l in range(level + 1, top + 1)) - 1)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def segment(leaves: list[str], top: int) -> list[str]:
    """The digests of a subtree in completion order, ``top`` levels high."""
    log, spine = [], [[] for _ in range(top + 1)]

    def append(level: int, digest: str) -> None:
        log.append(digest)
        spine[level].append(digest)
        if level < top and len(spine[level]) == WAYS:
            close(level)

    def close(level: int) -> None:
        run, spine[level] = spine[level], []
        append(level + 1, sha("".join(run)))

    for digest in leaves:
        append(0, digest)
    for level in range(top):  # what the last leaf leaves open
        if spine[level]:
            close(level)
    return log


def siblings(log: list[str], index: int, n: int, top: int) -> tuple[list[str], list[str]]:
    """For each level, the digests of the run's nodes before and after the own
    node, as text; addressed by position."""
    before, after = [], []
    for level in range(top):
        own, count = index // WAYS ** level, -(-n // WAYS ** level)
        first = own - own % WAYS
        run = [log[position(level, i, n, top)] for i in range(first, min(first + WAYS, count))]
        before.append("".join(run[:own - first]))
        after.append("".join(run[own - first + 1:]))
    return before, after


def fold(digest: str, before: list[str], after: list[str]) -> str:
    for left, right in zip(before, after):
        digest = sha(left + digest + right)
    return digest


# ------------------------------------------------------------------- leaves

def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast while it has few rows."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (gapless from 0) within ``tree`` by ``order``, and
    the tree's ``n``.

    Rows are dealt by range over tree and order, so a tree of any size takes
    many tasks, and a last column that differs between equal rows splits those
    too.  Each part numbers its own rows; the parts before add their counts,
    a table of a row a tree and part."""
    def number(batches):
        from pyspark import TaskContext

        part, tree, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            at = []
            for own in b.column(0).to_pylist():  # trees come one after the other
                if own != tree:
                    tree, seen = own, 0
                at.append(seen)
                seen += 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(at, pa.int64())],
                [*b.schema.names, "_part", "_at"])

    keys = ["tree", *order]
    rest = [c for c in rows.columns if c != "tree"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ["tree", *rest])
    dealt = rows.select("tree", *rest).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = staged(dealt.mapInArrow(number, f"{kinds}, _part int, _at long"), name)
    counts = parts.groupBy("tree", "_part").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(counts.select("tree", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"),
                                F.sum("_rows").over(whole).alias("n")), f"{name}-base")
    return (parts.join(_small(base), ["tree", "_part"])
            .select("tree", *rest, (F.col("_base") + F.col("_at")).alias("rank"), "n"))


# ------------------------------------------------------------------- building

def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / WAYS ** HEIGHT).cast("long"))


def _append(key, t):
    t = t.sort_by("rank")
    n = t["n"][0].as_py()
    log = segment([d.hex() for d in t["digest"].to_pylist()], min(HEIGHT, levels(n)))
    return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()),
                     "n": pa.array([n], pa.int64()), "leaves": pa.array([t.num_rows], pa.int64()),
                     "digests": pa.array([bytes.fromhex("".join(log))], pa.binary())})


def build(nodes: DataFrame, name: str = "merkle") -> list[DataFrame]:
    """The log of all trees of (tree, rank, n, digest): one written table a
    round, a row a segment: ``tree``, ``block``, ``n`` (the round's nodes of
    the tree), ``leaves`` of the segment and ``digests`` in completion order.

    A segment ends with its subtree's root; these are the nodes of the next
    round.  A round is ``WAYS ** HEIGHT`` times smaller than the one before."""
    rounds = []
    while True:
        log = staged(_blocks(nodes).groupBy("tree", "block").applyInArrow(
            _append, "tree string, block long, n long, leaves long, digests binary"), f"{name}-{len(rounds)}")
        rounds.append(log)
        nodes = log.select("tree", F.col("block").alias("rank"),
                           F.ceil(F.col("n") / WAYS ** HEIGHT).cast("long").alias("n"),
                           F.expr("substring(digests, -32, 32)").alias("digest"))
        if nodes.where("n > 1").isEmpty():
            return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root): the digest that remains of each tree."""
    return rounds[-1].select("tree", F.expr("substring(digests, -32, 32)").alias("root"))


# ------------------------------------------------------------------- proofs

def _prove(last):
    """(nodes of a block, its segment with the path above) -> ``last`` of them."""
    def run(left, right):
        before, after = [], []
        for row in right.to_pylist():  # one
            raw = row["digests"].hex()
            log = [raw[i:i + 64] for i in range(0, len(raw), 64)]
            first, top = row["block"] * WAYS ** HEIGHT, min(HEIGHT, levels(row["n"]))
            for rank in left["rank"].to_pylist():
                b, a = siblings(log, rank - first, row["leaves"], top)
                before.append(b + row["before"])
                after.append(a + row["after"])
        return last(left, before, after)

    return run


def _plain(rows: pa.Table, before: list, after: list) -> pa.Table:
    texts = pa.list_(pa.string())
    return pa.table({"tree": rows["tree"], "rank": rows["rank"],
                     "before": pa.array(before, texts), "after": pa.array(after, texts)})


PATH = "tree string, rank long, before array<string>, after array<string>"


def paths(nodes: DataFrame, rounds: list[DataFrame], above: DataFrame, schema: str = PATH,
          last=_plain, name: str = "merkle") -> DataFrame:
    """What ``last(rows, before, after)`` makes of the nodes that were built:
    the digests of the siblings before and after, a text a level from the leaf
    up, then those of the tree's root in ``above`` (tree, before, after)."""
    own = above.select("tree", F.lit(0).cast("long").alias("block"), "before", "after")
    for k in range(len(rounds) - 1, -1, -1):
        right = rounds[k].join(own, ["tree", "block"]).groupBy("tree", "block")
        left = nodes if k == 0 else rounds[k - 1].select("tree", F.col("block").alias("rank"))
        pairs = _blocks(left).groupBy("tree", "block").cogroup(right)
        if k == 0:
            return pairs.applyInArrow(_prove(last), schema)
        own = staged(pairs.applyInArrow(_prove(_plain), PATH).withColumnRenamed("rank", "block"),
                     f"{name}-paths-{k}")


# ------------------------------------------------------------------- manifest

@dataclass
class Manifest:
    """``leaves``: tree, id, rank, n, digest and the ``extra`` columns;
    ``rounds``: the log (``build``); ``trees``: own (the tree), its rank among
    trees, the digest of its root; ``top``: the log over the trees."""

    leaves: DataFrame
    rounds: list[DataFrame]
    trees: DataFrame
    top: list[DataFrame]


def manifest(docs: DataFrame, columns: tuple[str, ...], group: str, order: str,
             extra: dict[str, Column] | None = None) -> Manifest:
    """The trees of all rows: a leaf a row over ``columns``, a tree a value of
    ``group`` with its leaves by ``order``, and a tree over the groups in
    bytewise order (null first).

    A null is a value of its own in any column.  Rows that share an ``order``
    value follow by digest; equal rows are leaves of their own, in any order.
    Null order values come first.  An empty table has no leaves and no root.
    Other columns are read only by ``extra`` (name -> column, kept on the
    leaves).  Texts are hashed where they are read, whole; only digests move."""
    named = {"id": F.col(order), "digest": leaf(*[F.col(c) for c in columns])} | (extra or {})
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # sorts null first
    hashed = docs.select(tree.alias("tree"), *[c.alias(n) for n, c in named.items()])
    rows = staged(hashed.withColumn("_salt", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = _ranked(rows, ["id", "digest", "_salt"], "merkle-ranks").drop("_salt")
    rounds = build(leaves.select("tree", "rank", "n", "digest"), "merkle")
    found = roots(rounds).select(F.lit("all").alias("tree"), F.col("tree").alias("own"), F.col("root").alias("digest"))
    trees = _ranked(found, ["own"], "merkle-trees")
    top = build(trees.select("tree", "rank", "n", "digest"), "merkle-top")
    return Manifest(leaves, rounds, trees, top)


def proofs(m: Manifest, schema: str, last) -> DataFrame:
    """``last(rows, before, after)`` over the leaves, rows as in ``leaves``;
    ``before`` and ``after`` hold the siblings' digests of each level, via the
    tree's root up to the root of all."""
    nothing = F.array().cast("array<string>")
    none = m.top[-1].select("tree", nothing.alias("before"), nothing.alias("after"))
    upper = paths(m.trees.select("tree", "rank"), m.top, none, name="merkle-top")
    above = (upper.join(m.trees.select("tree", "rank", "own"), ["tree", "rank"])
             .select(F.col("own").alias("tree"), "before", "after"))
    return paths(m.leaves, m.rounds, staged(above, "merkle-above"), schema, last)


def node_list(rounds: list[DataFrame]) -> DataFrame:
    """(tree, level, index, position, digest) of every node of the trees:
    ``position`` is its place, from 0, in the tree's whole completion order."""
    whole = rounds[0].where("block = 0").select("tree", F.col("n").alias("total"))

    def listed(k: int):
        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    n, total = row["leaves"], row["total"]
                    top, out = min(HEIGHT, levels(row["n"])), []
                    for level in range(1 if k else 0, top + 1):
                        span, high = WAYS ** (HEIGHT - level), k * HEIGHT + level
                        for i in range(-(-n // WAYS ** level)):
                            at = 32 * position(level, i, n, top)
                            index = row["block"] * span + i
                            out.append((row["tree"], high, index, position(high, index, total, levels(total)),
                                        row["digests"][at:at + 32]))
                    made = zip(*out) if out else [[]] * 5
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(made, kinds)],
                        ["tree", "level", "index", "position", "digest"])

        return run

    schema = "tree string, level int, index long, position long, digest binary"
    parts = [log.join(whole, "tree").mapInArrow(listed(k), schema) for k, log in enumerate(rounds)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------- query

def _verified(rows: pa.Table, before: list, after: list) -> pa.Table:
    """Digests of proofs, and the roots that tampered (else own) leaves fold to."""
    proof, folded = [], []
    for own, changed, left, right in zip(rows["digest"].to_pylist(), rows["changed"].to_pylist(), before, after):
        proof.append(sha("".join(x for pair in zip(left, right) for x in pair)))
        folded.append(fold((own if changed is None else changed).hex(), left, right))
    return pa.table({"tree": rows["tree"], "doc_id": rows["id"], "digest": rows["digest"],
                     "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string())})


def op13_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document; where 3 divides the crc32 of
    the id, the root is folded from a lower-cased text."""
    docs = table(prepare(spark), sf_dir, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    lower = [F.col(c) for c in columns[:-1]] + [F.translate("text", UPPER, UPPER.lower())]
    m = manifest(docs, columns, "lang", "doc_id", {"changed": F.when(tampered, leaf(*lower))})
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = proofs(m, f"tree string, doc_id {kind}, digest binary, proof_sha256 string, folded_root string", _verified)
    ends = (m.trees.join(roots(m.top), "tree")
            .select(F.col("own").alias("tree"), F.lower(F.hex("digest")).alias("subroot"),
                    F.lower(F.hex("root")).alias("root")))
    return (found.join(_small(staged(ends, "merkle-ends")), "tree")
            .select("doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "proof_sha256",
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))
