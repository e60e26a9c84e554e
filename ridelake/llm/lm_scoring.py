"""Document scores by masked pseudo-likelihood.

A bidirectional window network predicts each word from the ``reach`` words on
either side: their embeddings, scaled by place, are summed and squashed, and a
two-level softmax (class, then member of the class) gives the word's hash
bucket.  The score of a document is the sum of the log-probabilities of all
its words, each given its own window with itself masked.

Training is data-parallel: every task starts from the same weights, takes one
pass of Adagrad steps in numpy with every word of all its documents as a
masked target, and hands in its weights; Spark averages them piece by piece,
weighted by the words seen, in two levels.  Only the averaged model
(of fixed size) reaches the driver.  Each round trains on another part of the
documents, all rounds together on every one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, span_hashes, split_words, table, text_slices, utf8_bytes


class WindowNet:
    """The network; ``2 ** bits`` word buckets in ``2 ** (bits // 2)`` classes."""

    NAMES = ("embed", "place", "by_class", "class_bias", "by_member", "member_bias")

    def __init__(self, bits: int = 12, width: int = 16, reach: int = 3, seed: int = 7):
        self.bits, self.width, self.reach = bits, width, reach
        self.classes = 1 << (bits // 2)
        self.members = (1 << bits) // self.classes
        rng = np.random.default_rng(seed)
        words = 1 << bits

        def small(*shape):
            return (rng.standard_normal(shape) / np.sqrt(width)).astype(np.float32)

        self.embed = np.vstack([small(words, width), np.zeros((1, width), np.float32)])  # last: outside
        self.place = np.ones((2 * reach, width), np.float32)
        self.by_class, self.class_bias = small(width, self.classes), np.zeros(self.classes, np.float32)
        self.by_member = small(words, width)
        self.member_bias = np.zeros(words, np.float32)

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_weights(self, flat: np.ndarray) -> WindowNet:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def windows(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Buckets around the places ``at`` of a padded sequence."""
        r = self.reach
        steps = np.array([*range(-r, 0), *range(1, r + 1)])
        return padded[at[:, None] + steps[None, :]]

    def _hidden(self, around):
        return np.tanh(np.einsum("nod,od->nd", self.embed.take(around, axis=0), self.place))

    def _order(self, buckets):
        """Places of the buckets by growing bucket; 16-bit keys sort fastest."""
        return np.argsort(buckets.astype(np.uint16) if self.bits < 16 else buckets, kind="stable")

    def _by_class(self, target):
        """(class, first and last place) of sorted targets."""
        of = target // self.members
        edge = np.flatnonzero(np.diff(of, prepend=-1))
        return list(zip(of[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(of)]))

    def _logits(self, h, parts):
        """Of the classes and of the members of each target's class, a column a
        target, less the largest of the column."""
        z = self.by_class.T @ h.T + self.class_bias[:, None]
        y = np.empty((self.members, len(h)), np.float32)
        for c, a, b in parts:
            own = slice(c * self.members, (c + 1) * self.members)
            np.matmul(self.by_member[own], h[a:b].T, out=y[:, a:b])
            y[:, a:b] += self.member_bias[own, None]
        z -= z.max(axis=0)
        y -= y.max(axis=0)
        return z, y

    def log_prob(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target in its window."""
        order = self._order(target)
        target, columns = target[order], np.arange(len(target))
        z, y = self._logits(self._hidden(around[order]), self._by_class(target))
        out = np.empty(len(target))
        out[order] = (z[target // self.members, columns].astype(np.float64) - np.log(np.exp(z).sum(axis=0))
                      + y[target % self.members, columns] - np.log(np.exp(y).sum(axis=0)))
        return out

    def step(self, around: np.ndarray, target: np.ndarray, seen: dict, rate: float) -> None:
        """One Adagrad step on the mean log-loss of a batch; ``seen`` keeps the
        sums of squares."""
        order = self._order(target)
        around, target = around[order], target[order]
        n, columns, parts = len(target), np.arange(len(target)), self._by_class(target)
        e = self.embed.take(around, axis=0)
        h = np.tanh(np.einsum("nod,od->nd", e, self.place))
        z, y = self._logits(h, parts)
        for d in (z, y):
            np.exp(d, out=d)
            d /= d.sum(axis=0)
        z[target // self.members, columns] -= 1
        y[target % self.members, columns] -= 1
        back = z.T @ self.by_class.T
        grads = {"by_class": h.T @ z.T, "class_bias": z.sum(axis=1),
                 "by_member": np.zeros_like(self.by_member), "member_bias": np.zeros_like(self.member_bias)}
        for c, a, b in parts:
            own = slice(c * self.members, (c + 1) * self.members)
            back[a:b] += y[:, a:b].T @ self.by_member[own]
            grads["by_member"][own] = y[:, a:b] @ h[a:b]
            grads["member_bias"][own] = y[:, a:b].sum(axis=1)
        back *= 1 - h * h
        grads["place"] = np.einsum("nod,nd->od", e, back)
        flat = around.ravel()
        order = self._order(flat)
        edge = np.flatnonzero(np.diff(flat[order], prepend=-1))
        each = back.take(order // around.shape[1], axis=0)
        each *= self.place.take(order % around.shape[1], axis=0)
        grads["embed"] = np.zeros_like(self.embed)
        grads["embed"][flat[order[edge]]] = np.add.reduceat(each, edge, axis=0)
        grads["embed"][-1] = 0
        for name, g in grads.items():
            g /= n
            s = seen.setdefault(name, np.full(g.shape, 1e-8, np.float32))
            s += g * g
            getattr(self, name).__isub__(rate * g / np.sqrt(s))


def buckets(data: np.ndarray, offsets: np.ndarray, net: WindowNet):
    """Word buckets of concatenated texts, each text padded on both sides:
    (padded sequence, place of each word in it, row of each word)."""
    starts, ends, row = split_words(data, offsets)
    ids = (span_hashes(data, starts, ends) >> np.uint64(64 - net.bits)).astype(np.int64)
    at = np.arange(len(ids)) + (row + 1) * net.reach
    padded = np.full(len(ids) + (len(offsets) + 1) * net.reach, 1 << net.bits, np.int64)
    padded[at] = ids
    return padded, at, row


PIECE = 1 << 14
BATCH = 1 << 13
LANE_TASKS = 256  # weights that one task averages at once: 16 MB of pieces


def _train_task(model, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen, n = WindowNet(*model.value[0]).set_weights(model.value[1]), {}, 0
        for b in batches:
            for part in text_slices(b):
                padded, at, _ = buckets(*utf8_bytes(part.column(0)), net)
                for lo in range(0, len(at), BATCH):
                    own = at[lo:lo + BATCH]
                    net.step(net.windows(padded, own), padded[own], seen, rate)
                    n += len(own)
        if n:
            flat = net.weights()
            pieces = [flat[i:i + PIECE] for i in range(0, len(flat), PIECE)]
            lane = TaskContext.get().partitionId() // LANE_TASKS
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(pieces))), pa.array(np.full(len(pieces), lane)),
                 pa.array(np.full(len(pieces), n)),
                 pa.array([p.tobytes() for p in pieces], pa.binary())], ["piece", "lane", "n", "w"])

    return run


def _averaged(key, t):
    """The weighted mean of the pieces of one group, taken one at a time."""
    total, mean = 0, None
    for n, w in zip(t["n"].to_pylist(), t["w"]):
        total += n
        w = np.frombuffer(w.as_py(), np.float32).astype(np.float64)
        mean = w if mean is None else mean + (w - mean) * (n / total)
    return pa.table({"piece": [t["piece"][0].as_py()], "lane": [0], "n": [total],
                     "w": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, bits: int = 12, width: int = 16, reach: int = 3, rounds: int = 2,
          rate: float = 0.1) -> WindowNet:
    """The network after ``rounds`` rounds; together they read every document
    once, with each of its words as a target.  Without any words the first
    weights stay."""
    schema, sc = "piece long, lane long, n long, w binary", docs.sparkSession.sparkContext
    net = WindowNet(bits, width, reach)
    for k in range(rounds):
        model = sc.broadcast(((bits, width, reach), net.weights()))  # fixed size
        mine = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k).select("text")
        lanes = (mine.mapInArrow(_train_task(model, rate), schema)
                 .groupBy("piece", "lane").applyInArrow(_averaged, schema))
        pieces = lanes.groupBy("piece").applyInArrow(_averaged, schema).orderBy("piece").toArrow()
        if pieces.num_rows:
            net.set_weights(np.concatenate([np.frombuffer(w.as_py(), np.float32) for w in pieces["w"]]))
    return net


def score(docs: DataFrame, net: WindowNet) -> DataFrame:
    """(doc_id, n_words, log_prob, per_word) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(
        ((net.bits, net.width, net.reach), net.weights()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WindowNet(*model.value[0]).set_weights(model.value[1])
        for b in batches:
            for part in text_slices(b):
                padded, at, row = buckets(*utf8_bytes(part.column(1)), own)
                total, n = np.zeros(part.num_rows), np.bincount(row, minlength=part.num_rows)
                for lo in range(0, len(at), BATCH):
                    here = at[lo:lo + BATCH]
                    lp = own.log_prob(own.windows(padded, here), padded[here])
                    total += np.bincount(row[lo:lo + BATCH], weights=lp, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(total),
                     pa.array(total / np.maximum(n, 1), mask=n == 0)],
                    ["doc_id", "n_words", "log_prob", "per_word"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, log_prob double, per_word double")


def score_documents(docs: DataFrame, **settings) -> DataFrame:
    """Train on ``docs`` and score them.

    Words are runs without ASCII white space, whole texts.  A text without
    words (null, empty) has ``log_prob`` 0 and a null ``per_word``.  Repeated
    rows train and are scored each; an empty table gives no rows; other columns
    are not read.
    """
    return score(docs, train(docs, **settings))


def op8_masked_lm_scores(spark, sf_dir):
    """All documents, scored by a network trained on all of them."""
    return score_documents(table(prepare(spark), sf_dir, "documents"))
