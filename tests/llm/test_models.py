import random

import numpy as np
from llm_fixtures import edge_rows, empty, frame, prose

from ridelake.llm import lm_scoring, quality_classifier as qc


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in qc.classify(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    low = [got[r.doc_id].p_low >= 0.5 for r in held if r.quality == 0]
    clean = [got[r.doc_id].kept for r in held if r.quality == 1 and r.toxic == 0]
    assert np.mean(low) > 0.9 and np.mean(clean) > 0.97


def test_toxic_words_are_learnt(spark):
    rows, rng = [], random.Random(12)
    for i in range(400):
        w = prose(rng, 40).split()
        if i % 8 == 0:
            w[i % 40] = ("vile", "foul", "nasty")[i // 8 % 3]
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(400) if i % 5],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in qc.classify(frame(spark, rows), labels).collect()}
    held = [i for i in range(400) if i % 5 == 0]
    assert all(got[i] == bool(i % 8) for i in held)


def test_classifier_edge_cases(spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, None), (None, 0, 1), (999, 0, 0), (-5, 0, 0)],
                                   "doc_id long, quality int, toxic int").withColumn("text", _one())
    rows = edge_rows()
    got = qc.classify(frame(spark, rows), labels, keep=("doc_id", "lang")).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.doc_id in (0, 1, 2))  # no words
    no = qc.classify(frame(spark, rows), labels.where("1 = 0")).collect()
    assert len(no) == len(rows) and max(r.p_toxic for r in no) < 0.5
    assert qc.classify(empty(spark), labels).count() == 0


def _one():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_em_finds_the_accurate_labellers():
    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.2
    votes = np.full((6000, 4), qc.NONE)
    for j, (right, cover) in enumerate(((0.95, 0.6), (0.9, 0.5), (0.55, 0.6), (0.97, 0.3))):
        say = np.where(rng.random(6000) < right, truth, ~truth)
        on = rng.random(6000) < cover
        votes[on, j] = np.where(say[on], qc.BAD, qc.GOOD)
    each, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post = qc.fit_labellers(each, n.astype(float), trust=0.9)[at.ravel()]
    voted = (votes[:, [0, 1, 3]] != qc.NONE).any(axis=1)
    assert ((post > 0.5) == truth)[voted].mean() > 0.9


def test_network_matches_plain_loops():
    net = lm_scoring.WindowNet(bits=6, width=4, reach=2, seed=1)
    texts = [b"one two three four five", b"", b"one", b"two one two one"]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    padded, at, row = lm_scoring.buckets(np.frombuffer(b"".join(texts), np.uint8), offsets, net)
    got = net.log_prob(net.windows(padded, at), padded[at])
    k = 0
    for r, t in enumerate(texts):
        ids = [int(padded[p]) for p in at[row == r]]
        assert len(ids) == len(t.split())
        for i, target in enumerate(ids):
            h = np.zeros(4)
            for o, d in enumerate((-2, -1, 1, 2)):
                j = i + d
                e = net.embed[ids[j] if 0 <= j < len(ids) else 64]
                h += e * net.place[o]
            h = np.tanh(h)
            z = h @ net.by_class + net.class_bias
            c = target // 8
            y = net.by_member[c * 8:c * 8 + 8] @ h + net.member_bias[c * 8:c * 8 + 8]
            want = z[c] - np.log(np.exp(z).sum()) + y[target % 8] - np.log(np.exp(y).sum())
            assert abs(got[k] - want) < 1e-4
            k += 1


def test_steps_lower_the_loss():
    net, seen = lm_scoring.WindowNet(bits=6, width=8, reach=2), {}
    padded = np.concatenate(([64, 64], np.tile([1, 9, 30, 42, 17], 200), [64, 64]))
    at = np.arange(2, 1002)
    w = net.windows(padded, at)
    before = net.log_prob(w, padded[at]).mean()
    for _ in range(60):
        net.step(w, padded[at], seen, 0.1)
    assert net.log_prob(w, padded[at]).mean() > before + 2


def test_scores(spark):
    rows = edge_rows()
    got = lm_scoring.score_documents(frame(spark, rows), bits=8, width=8).collect()
    assert len(got) == len(rows)
    assert all((r.per_word is None) == (r.n_words == 0) and r.log_prob <= 0 for r in got)
    assert len({(r.n_words, round(r.log_prob, 3)) for r in got if r.doc_id in (5, 6)}) == 1
    assert lm_scoring.score_documents(empty(spark)).count() == 0


def test_every_word_is_a_target(spark):
    # each word follows one word only, so a rule on word pairs would leave some out in every place
    words = [f"w{i}" for i in range(16)]
    net = lm_scoring.train(frame(spark, [(i, " ".join(words * 20)) for i in range(16)]), bits=10, width=4, reach=2)
    texts = [w.encode() for w in words]
    padded, at, _ = lm_scoring.buckets(np.frombuffer(b"".join(texts), np.uint8),
                                       np.cumsum([0, *map(len, texts)]), net)
    # only a target pulls its own bias up within its class
    assert (net.member_bias[padded[at]] > 0).all()


def test_steps_follow_the_numerical_gradient():
    net = lm_scoring.WindowNet(bits=4, width=3, reach=2, seed=5)
    ids = np.random.default_rng(8).integers(0, 16, 30)
    padded = np.concatenate(([16, 16], ids, [16, 16]))
    at = np.arange(2, 32)
    w, target = net.windows(padded, at), padded[at]
    before = net.weights()
    # sums of squares of 1: a step of rate 1 is -g / sqrt(1 + g * g)
    net.step(w, target, {n: np.ones(getattr(net, n).shape, np.float32) for n in net.NAMES}, 1.0)
    move = (net.weights() - before).astype(np.float64)
    analytic = -move / np.sqrt(1 - move * move)

    def loss(flat):
        return -net.set_weights(flat).log_prob(w, target).mean()

    outside = range(16 * 3, 17 * 3)  # stays zero: what stands beyond a text
    for i in range(len(before)):
        up, down = before.copy(), before.copy()
        up[i] += 0.01
        down[i] -= 0.01
        want = 0 if i in outside else (loss(up) - loss(down)) / 0.02
        assert abs(analytic[i] - want) < 2e-3, i


def test_held_out_prose_scores_above_shuffled_words_and_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    net, rng, rows = lm_scoring.train(docs.where("doc_id % 10 <> 7")), random.Random(1), []
    held = docs.where("doc_id % 10 = 7 AND length(text) > 200").collect()
    for i, r in enumerate(held):
        words = r.text.split()
        noise = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in words]
        for j, each in enumerate((words, rng.sample(words, len(words)), noise)):
            rows.append((3 * i + j, " ".join(each)))
    got = {r.doc_id: r.per_word for r in lm_scoring.score(frame(spark, rows), net).collect()}
    scores = np.array([[got[3 * i + j] for j in range(3)] for i in range(len(held))])
    above_shuffled, above_noise = (scores[:, :1] > scores[:, 1:]).mean(axis=0)
    assert len(held) > 20 and above_shuffled > 0.6 and above_noise > 0.9, (above_shuffled, above_noise)
