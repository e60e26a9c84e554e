"""Quality classifier trained from weak labels.

Overlapping heuristics (and the given labels, where there are any) vote bad,
good or not at all on every document.  Expectation-maximisation over the
counts of vote patterns of the whole corpus estimates how each labeller votes
on bad and on good documents (Dawid and Skene, 1979), and so the posterior of
each pattern.  The posteriors are the targets of a linear scorer over hashed
words and binned shape statistics, which then scores every document.

Two such models decide: low quality and toxic.  Toxicity has no heuristics of
its own, so its labellers are two word lists, each learnt from one half of the
labelled sample.

Only the fit works on a sample (``max_train`` documents, labelled ones first,
chosen by a hash of the id); patterns are counted, and scores given, over all
documents and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (IS_MARK, IS_NEWLINE, LOWER, mix64, prepare, span_hashes, split_words, table,
                     text_slices, utf8_bytes)

BUCKETS = 1 << 18
EDGES = np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75])
#: Shape statistic: good at most, bad at least (``distinct``: the other way round).
SHAPES = (("upper", 0.12, 0.3), ("symbols", 0.05, 0.2), ("shouts", 0.05, 0.3),
          ("stutter", 0.05, 0.2), ("same_lines", 0.25, 0.5), ("distinct", 0.5, 0.3))
MIN_WORDS = 20  # shares of fewer words say nothing

BAD, GOOD, NONE = 0, 1, 2
LABELLERS = len(SHAPES) + 2
_UPPER, _LETTER, _SYMBOL = (np.zeros(256, bool) for _ in range(3))
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


# -------------------------------------------------------------------- features

def shapes_and_words(data: np.ndarray, offsets: np.ndarray):
    """Word counts, shape statistics (row x statistic), and the distinct word
    buckets of all rows with the row of each."""
    rows = len(offsets) - 1
    low = LOWER[data] if len(data) else data
    starts, ends, row = split_words(low, offsets, IS_MARK)
    h = span_hashes(low, starts, ends)

    def per_row(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    n = np.bincount(row, minlength=rows)
    of = np.maximum(n, 1)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    # one number a (row, word) pair: the row lifts the word's hash
    _, one = np.unique(mix64(h ^ mix64(row.astype(np.uint64))), return_index=True)
    distinct = np.bincount(row[one], minlength=rows)
    ls, le, lr = split_words(data, offsets, IS_NEWLINE)
    lines = np.bincount(lr, minlength=rows)
    _, first = np.unique(mix64(span_hashes(data, ls, le) ^ mix64(lr.astype(np.uint64))),
                         return_index=True)
    kinds = np.bincount(lr[first], minlength=rows)
    x = np.stack([per_row(_UPPER[data]) / np.maximum(per_row(_LETTER[data]), 1),
                  per_row(_SYMBOL[data]) / of, per_row(data == ord("!")) / of,
                  np.bincount(row, weights=same, minlength=rows) / of,
                  1 - kinds / np.maximum(lines, 1), distinct / of], axis=1)
    # one bucket may take several words of a row
    packed = np.unique((row[one].astype(np.uint64) << np.uint64(18)) | (h[one] >> np.uint64(46)))
    return n, x, (packed >> np.uint64(18)).astype(np.int64), (packed & np.uint64(BUCKETS - 1)).astype(np.int64)


def shape_votes(n: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Votes (row x labeller): each shape says bad or nothing, one labeller
    says good where no shape is odd, and one says bad where there are no words."""
    votes = np.full((len(n), LABELLERS), NONE)
    enough = n >= MIN_WORDS
    calm = enough.copy()
    for j, (_, good, bad) in enumerate(SHAPES):
        up = good < bad
        calm &= (x[:, j] <= good) if up else (x[:, j] >= good)
        votes[enough & ((x[:, j] >= bad) if up else (x[:, j] <= bad)), j] = BAD
    votes[calm, -2] = GOOD
    votes[n == 0, -1] = BAD
    return votes


def features(n: np.ndarray, x: np.ndarray, row: np.ndarray, bucket: np.ndarray):
    """(row, feature) pairs sorted by row: word buckets, then binned shapes."""
    bins = np.digitize(x, EDGES) + np.arange(x.shape[1]) * 16 + BUCKETS
    bins[n < MIN_WORDS] = BUCKETS + 16 * x.shape[1]
    r = np.concatenate((row, np.repeat(np.arange(len(n)), x.shape[1])))
    f = np.concatenate((bucket, bins.ravel()))
    order = np.argsort(r, kind="stable")
    return r[order], f[order]


N_FEATURES = BUCKETS + 16 * (len(SHAPES) + 1)


def word_votes(rows: int, row: np.ndarray, bucket: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Votes of word lists: bad where a word of the list occurs, else good; an
    empty list does not vote."""
    votes = np.full((rows, len(lists)), NONE)
    for j, words in enumerate(lists):
        if len(words):
            votes[:, j] = GOOD
            votes[row[np.isin(bucket, words)], j] = BAD
    return votes


# ----------------------------------------------------------- label model, scorer

def fit_labellers(patterns: np.ndarray, counts: np.ndarray, trust: float = 0.995,
                  rounds: int = 200) -> np.ndarray:
    """Posterior of "bad" for each vote pattern (pattern x labeller), by EM.

    A labeller has an accuracy for each kind of vote: the share of bad
    documents among those it so votes on.  Not to vote is no evidence.  It
    starts from "bad if anyone says so", which also counts as two documents a
    labeller.  The last labeller is the given label, whose accuracy is
    ``trust`` at least."""
    first = {BAD: 0.9, GOOD: 0.02}
    post = np.where((patterns == BAD).any(axis=1), first[BAD], first[GOOD])
    share = post @ counts / max(counts.sum(), 1)
    for _ in range(rounds if len(patterns) else 0):
        prior = _logit((post @ counts + 2 * share) / (counts.sum() + 2))
        odds = np.full(len(patterns), prior)
        for j in range(patterns.shape[1]):
            for vote in (BAD, GOOD):
                on = patterns[:, j] == vote
                rate = (post[on] @ counts[on] + 2 * first[vote]) / (counts[on].sum() + 2)
                if j == patterns.shape[1] - 1:
                    rate = max(rate, trust) if vote == BAD else min(rate, 1 - trust)
                odds[on] += _logit(rate) - prior
        old, post = post, 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(post - old).max() < 1e-6:
            break
    return post


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def one_of_each_text(rows: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The first row of each set of rows with the same words."""
    order = np.argsort(row, kind="stable")
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix64(bucket[order].astype(np.uint64)))))
    edge = np.searchsorted(row[order], np.arange(rows + 1))
    return np.unique(sums[edge[1:]] - sums[edge[:-1]], return_index=True)[1]


def screened(rows: int, row: np.ndarray, feature: np.ndarray, target: np.ndarray,
             least_z: float = 4.0, least_share: float = 0.004) -> np.ndarray:
    """Features that mark bad documents, by forward selection: the one whose
    share of bad documents stands out most (in standard errors), then again
    without the bad documents that it explains.  So the other words of a group
    of near copies are not taken for marks once one of them is."""
    least_rows = max(4, int(target.sum() * least_share))
    live, chosen = np.ones(rows, bool), []
    while rows:
        n = np.bincount(feature, minlength=N_FEATURES).astype(float)
        bad = np.bincount(feature, weights=target[row], minlength=N_FEATURES)
        p = target[live].mean() if live.any() else 0.0
        z = (bad - n * p) / np.sqrt(np.maximum(n * p * (1 - p), 1e-9))
        z[(n < least_rows) | (bad < n / 2)] = 0
        best = int(np.argmax(z))
        if z[best] < least_z:
            break
        chosen.append(best)
        gone = np.zeros(rows, bool)
        gone[row[feature == best]] = True
        gone &= target >= 0.5
        live &= ~gone
        left = ~gone[row] & (feature != best)
        row, feature = row[left], feature[left]
    return np.array(sorted(chosen), np.int64)


def fit_scorer(rows: int, row: np.ndarray, feature: np.ndarray, target: np.ndarray,
               steps: int = 300, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on the screened features: weights of all features, bias."""
    weights = np.zeros(N_FEATURES)
    if not rows or target.max() < 0.5:
        return weights, -10.0
    chosen = screened(rows, row, feature, target)
    at = np.searchsorted(chosen, feature)
    at[at == len(chosen)] = 0
    use = chosen[at] == feature if len(chosen) else np.zeros(len(feature), bool)
    r, f = row[use], at[use]
    w, b = np.zeros(len(chosen)), float(np.log((target.mean() + 1e-3) / (1.001 - target.mean())))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):  # Adam on the full sample
        s = np.bincount(r, weights=w[f], minlength=rows) + b
        err = 1 / (1 + np.exp(-np.clip(s, -30, 30))) - target
        g = np.append(np.bincount(f, weights=err[r], minlength=len(w)) / rows + l2 * w, err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights[chosen] = w
    return weights, float(b)


# ------------------------------------------------------------------------ jobs

def _given(labels: DataFrame) -> DataFrame:
    """One row a labelled document; of contradicting labels the bad one holds."""
    return (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1], dtype=np.int64))


def _votes_of(code: np.ndarray, labellers: int) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(labellers) % 3


def _each_slice(run):
    """mapInArrow function over slices of bounded text; column 1 is the text."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for part in text_slices(b):
                yield run(part, *shapes_and_words(*utf8_bytes(part.column(1))))

    return batches


def _sample_rows(part, n, x, row, bucket):
    code = _pattern(shape_votes(n, x))
    r, f = features(n, x, row, bucket)
    cut = np.searchsorted(r, np.arange(1, len(n)))
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(code), pa.array([p.astype(np.int32) for p in np.split(f, cut)] if len(n) else [],
                                                  pa.list_(pa.int32()))],
        ["doc_id", "code", "features"])


class Model:
    """What scores a document: two linear scorers over the same features."""

    def __init__(self, low, toxic):
        self.low, self.toxic = low, toxic

    def scores(self, n, x, row, bucket):
        r, f = features(n, x, row, bucket)
        out = []
        for weights, bias in (self.low, self.toxic):
            s = np.bincount(r, weights=weights[f], minlength=len(n)) + bias
            out.append(1 / (1 + np.exp(-np.clip(s, -30, 30))))
        out[0][n == 0] = 1.0
        return out


def train(docs: DataFrame, labels: DataFrame, max_train: int = 8_000) -> Model:
    """Fit the label models on the vote patterns of all ``docs`` and the two
    scorers on at most ``max_train`` of them."""
    spark = docs.sparkSession
    given = _given(labels)
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(given, "doc_id", "left")
    chosen = (ids.orderBy(F.col("quality").isNull() & F.col("toxic").isNull(), F.xxhash64("doc_id"))
              .limit(max_train))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # the broadcast is bounded by max_train ids; of rows that share an id one is
    # taken, by a hash of its text, before anything reaches the driver
    order = F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
    picked = (docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")
              .groupBy("doc_id").agg(F.min_by(F.coalesce("text", F.lit("")), order).alias("text")))
    got = (picked.mapInArrow(_each_slice(_sample_rows), f"doc_id {kind}, code long, features array<int>")
           .join(F.broadcast(chosen), "doc_id").toArrow().sort_by("doc_id"))
    rows = got.num_rows
    code = got["code"].to_numpy()
    lists = got["features"].combine_chunks()
    # 32-bit: the sample is what the driver's memory is for
    feature = lists.flatten().to_numpy()
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(lists.offsets.to_numpy())) if rows \
        else np.zeros(0, np.int32)
    low, tox = (np.nan_to_num(got[c].to_numpy().astype(float), nan=-1) for c in ("quality", "toxic"))

    # two word lists, each learnt from one half of the rows with a toxic label;
    # of texts with the same words one row counts
    words = feature < BUCKETS
    single = np.zeros(rows, bool)
    single[one_of_each_text(rows, row[words], feature[words])] = True
    half = np.cumsum(single) % 2
    word_lists = []
    for k in (0, 1):
        known = np.flatnonzero((tox >= 0) & single & (half == k))
        place = np.full(rows, -1)
        place[known] = np.arange(len(known))
        use = words & (place[row] >= 0) if rows else words
        target = (tox[known] == 1).astype(float)
        word_lists.append(screened(len(known), place[row[use]], feature[use], target))

    def vote_codes(part, n, x, r, bucket):
        lists = word_votes(len(n), r, bucket, word_lists)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(_pattern(shape_votes(n, x))), pa.array(_pattern(lists))],
            ["doc_id", "shape", "words"])

    votes = (docs.select("doc_id", "text")
             .mapInArrow(_each_slice(vote_codes), f"doc_id {kind}, shape long, words long")
             .join(given, "doc_id", "left"))
    label = "CASE WHEN {c} IS NULL THEN 2 WHEN {c} = {bad} THEN 0 ELSE 1 END"
    counted = (votes.selectExpr("shape", "words", label.format(c="quality", bad=0) + " AS q",
                                label.format(c="toxic", bad=1) + " AS t")
               .groupBy("shape", "words", "q", "t").count().toArrow())  # a bounded number of patterns
    count = counted["count"].to_numpy().astype(float)

    def posterior(codes, labellers, given_vote, own_codes, own_given):
        patterns = np.column_stack([_votes_of(codes, labellers), given_vote])
        each, at = np.unique(patterns, axis=0, return_inverse=True)
        post = fit_labellers(each, np.bincount(at.ravel(), weights=count))
        known = {tuple(p): q for p, q in zip(each.tolist(), post)}
        own = np.column_stack([_votes_of(own_codes, labellers), own_given])
        return np.array([known[tuple(p)] for p in own.tolist()])

    own_q = np.where(low < 0, NONE, np.where(low == 0, BAD, GOOD))
    own_t = np.where(tox < 0, NONE, np.where(tox == 1, BAD, GOOD))
    own_words = _pattern(word_votes(rows, row[words], feature[words], word_lists))
    target = posterior(counted["shape"].to_numpy(), LABELLERS, counted["q"].to_numpy(), code, own_q) \
        if rows else np.zeros(0)
    toxic = posterior(counted["words"].to_numpy(), len(word_lists), counted["t"].to_numpy(),
                      own_words, own_t) if rows else np.zeros(0)
    use = single[row] if rows else words
    place = np.cumsum(single) - 1
    own = (int(single.sum()), place[row[use]] if rows else row, feature[use])
    return Model(fit_scorer(*own, target[single]), fit_scorer(*own, toxic[single]))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = 8_000, limit: float = 0.5,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row, with ``p_low``, ``p_toxic`` and ``kept``
    (both below ``limit``).

    A text without words (null, empty, marks only) is of low quality.  Rows
    that repeat an id are scored each; a null id is scored and never trained
    on.  Without labels the heuristics alone decide and nothing is toxic.
    Empty tables give no rows; columns not in ``keep`` are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))

    def scored(part, n, x, row, bucket):
        low, toxic = model.value.scores(n, x, row, bucket)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(low), pa.array(toxic), pa.array((low < limit) & (toxic < limit))],
            ["_row", "p_low", "p_toxic", "kept"])

    source = docs.select(F.struct(*keep).alias("_row"), "text")
    row = source.schema["_row"].dataType.simpleString()
    return source.mapInArrow(_each_slice(scored), f"_row {row}, p_low double, p_toxic double, kept boolean") \
        .select(*[F.col(f"_row.{c}") for c in keep], "p_low", "p_toxic", "kept")


def op10_weak_label_classifier(spark, sf_dir):
    """All documents, scored and judged."""
    prepare(spark)
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
