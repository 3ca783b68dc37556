import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import quality, toxicity
from strata.llm._labelled import dealt, fold, labelled_sample, labelled_texts, per_shard, totals
from strata.llm._text import ALNUM, split_words
from tests.llm.cases import LABEL, clashing, docs, odd_rows

SF = "/root/testdata/sf0.01"


def held_out(spark, scores, label, parts, value, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scores.join(labels, "doc_id").filter(fold("doc_id", parts) == value).select("score", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def auc(s, y):
    a, b = s[y == 1], s[y == 0]
    return ((a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean())


def test_quality_ranks_held_out_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(d, spark.read.parquet(f"{SF}/labels.parquet"), allowed=lambda c: fold(c, 4) != 2)
    s, y = held_out(spark, quality.score_texts(d, model), "quality", 4, 2)
    assert auc(s, y) > 0.97
    assert ((s >= 0.7) == (y == 1)).mean() > 0.93


def test_quality_threshold_is_the_quantile_of_the_sample():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 5))
    y = (x[:, 0] + 0.1 * rng.standard_normal(400) > 0.5).astype(int)
    model = quality.train(x, y, quality.RankParams(pairs=2000))
    assert abs((model.score(x) < 0.7).mean() - (y == 0).mean()) < 0.01
    assert auc(model.score(x), y) > 0.97


def test_pair_loss_gradient_moves_preferred_up():
    x = np.array([[0.0], [1.0], [0.1], [0.9]])
    model = quality.train(x, np.array([0, 1, 0, 1]), quality.RankParams(pairs=100))
    s = model.raw(x)
    assert min(s[1], s[3]) > max(s[0], s[2])


def test_ranking_equals_a_plain_fit():
    """The pair loss summed pair by pair in plain Python, with the same steps."""
    rng = np.random.default_rng(4)
    x, y = rng.standard_normal((14, 2)), np.array([0, 1] * 7)
    p = quality.RankParams(pairs=25, steps=4)
    got = quality.train(x, y, p)
    rng = np.random.default_rng(p.seed)
    good, bad = [i for i in range(14) if y[i]], [i for i in range(14) if not y[i]]
    pairs = list(zip(rng.choice(good, p.pairs).tolist(), rng.choice(bad, p.pairs).tolist()))
    e = got.expand(x).tolist()
    w, squares = [0.0] * len(e[0]), [1e-8] * len(e[0])
    for _ in range(p.steps):
        grad = [p.l2 * v for v in w]
        for a, b in pairs:
            diff = sum(v * (s - t) for v, s, t in zip(w, e[a], e[b]))
            lose = 1 / (1 + np.exp(diff))
            for k in range(len(w)):
                grad[k] -= lose * (e[a][k] - e[b][k]) / p.pairs
        for k, g in enumerate(grad):
            squares[k] += g * g
            w[k] -= p.rate * g / squares[k] ** 0.5
    assert np.allclose(got.weights, w, atol=1e-9)


def small_cnn():
    return toxicity.CnnParams(word_buckets=20, prefix_buckets=10, dim=2, filters=3, steps=1, batch=5, rate=1e-3)


def plain_score(net, ids):
    """Convolution over the words and empty rows after them, maximum, logistic layer: plain loops."""
    pad = max(net.p.widths)
    x = [sum(net.emb[k].astype(float) for k in row) for row in ids] + [np.zeros(net.p.dim)] * pad
    pooled = []
    for w, conv, bias in zip(net.p.widths, net.conv, net.bias):
        for f in range(net.p.filters):
            windows = [float(np.concatenate(x[at:at + w]) @ conv[:, f].astype(float)) for at in range(len(x) - w + 1)]
            pooled.append(max(0.0, max(windows) + float(bias[f])))
    return 1 / (1 + np.exp(-(np.array(pooled) @ net.out.astype(float) + float(net.out_bias[0]))))


def test_scores_equal_a_plain_convolution():
    net = toxicity.Cnn(small_cnn())
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 30, (n, 4)).astype(np.int32) for n in (1, 2, 3, 9, 0)]
    got = net.score(np.concatenate(texts), np.array([len(t) for t in texts]))
    assert np.allclose(got, [plain_score(net, t) for t in texts], atol=1e-5)


def test_one_training_step_goes_down_the_numeric_gradient():
    p = small_cnn()
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 30, (n, 4)).astype(np.int32) for n in (4, 7, 3, 5, 6)]
    labels = [0, 1, 1, 0, 1]

    def loss(net):
        s = np.array([net.score(t, np.array([len(t)]))[0] for t in texts])
        return -np.mean(np.where(np.array(labels) == 1, np.log(s), np.log(1 - s)))

    before, after = toxicity.Cnn(p), toxicity.train_ids(texts, labels, p)
    assert loss(after) < loss(before)
    checked = 0
    for a, b in zip([before.emb, *before.arrays()], [after.emb, *after.arrays()]):
        flat, moved = a.reshape(-1), (b - a).reshape(-1)
        for k in rng.choice(flat.size, min(40, flat.size), replace=False):
            old, e, here = flat[k], 2e-3, loss(before)
            flat[k] = old + e
            up = (loss(before) - here) / e
            flat[k] = old - e
            down = (here - loss(before)) / e
            flat[k] = old
            if min(up * down, abs(up), abs(down)) > 0 and min(abs(up), abs(down)) > 2e-3:  # no kink within e
                # the first step moves each weight against its slope's sign
                assert np.sign(moved[k]) == -np.sign(up)
                checked += 1
    assert checked > 20


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    net = toxicity.fit(d, labels, allowed=lambda c: fold(c, 3) != 1)
    s, y = held_out(spark, toxicity.score_texts(d, net), "toxic", 3, 1, sf)
    assert y.sum() > 100 and ((s >= 0.7) == (y == 1)).mean() > 0.94


def test_the_sample_is_the_same_whatever_the_order_and_stays_within_its_budget(spark):
    rows = [(i % 40, f"text {i} " * (i % 7)) for i in range(120)] + [(3, None)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] * 2, LABEL)
    encode = lambda col: [(t or "").encode() for t in col.to_pylist()]
    draw = lambda r, budget: labelled_sample(docs(spark, r), labels, "toxic", lambda c: F.lit(True), (15, 15), 40, encode, budget)
    one = draw(rows, 1 << 20)
    assert one == draw(rows[::-1], 1 << 20) and len(one) == 30 and max(len(r[0]) for r in one) <= 40
    few = draw(rows, 300)
    assert 0 < len(few) < 30 and sum(len(r[0]) for r in few) <= 300 and set(few) <= set(one)


def test_toxicity_finds_planted_words_in_held_out_texts():
    """Full-size training on generated texts: bad words and words with a bad stem."""
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("abdeglmnorst"), rng.integers(2, 7))) for _ in range(4000)]
    texts, y = [], []
    for i in range(900):
        w = [vocab[k] for k in rng.integers(0, len(vocab), rng.integers(5, 300))]
        bad = i % 3 == 0
        if bad:
            for _ in range(2):
                w.insert(rng.integers(0, len(w)), rng.choice(["zzidot", "qovex" + rng.choice(vocab)]))
        texts.append(" ".join(w))
        y.append(int(bad))
    p = toxicity.CnnParams()
    net = toxicity.train(texts[:600], y[:600], p)
    s = np.concatenate([net.score(toxicity.word_ids(w, p), w.counts) for w in split_words(pa.array(texts[600:]), ALNUM)])
    assert ((s >= 0.7) == np.array(y[600:])).mean() > 0.97


def test_toxicity_scores_do_not_depend_on_neighbours():
    p = toxicity.CnnParams()
    net = toxicity.Cnn(p)
    texts = ["a b c", "", "d e", "x"]
    every = np.concatenate([net.score(toxicity.word_ids(w, p), w.counts) for w in split_words(pa.array(texts), ALNUM)])
    for t, s in zip(texts, every):
        (w,) = split_words(pa.array([t]), ALNUM)
        assert net.score(toxicity.word_ids(w, p), w.counts)[0] == pytest.approx(s, abs=1e-6)


def test_thresholds_are_calibrated_by_language():
    s, y = np.array([0.1, 0.2, 0.4, 0.5]), np.array([0, 0, 1, 1])
    assert 0.2 < toxicity.best_threshold(s, y, 0.7) <= 0.4
    assert toxicity.best_threshold(np.array([0.1, 0.9]), np.array([0, 1]), 0.7) == 0.7


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_without_usable_labels(spark, module):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 1), (99, 0, 0)], LABEL)
    for table in (labels, labels.limit(0)):
        model = module.fit(docs(spark, odd_rows()), table)
        out = module.score_texts(clashing(docs(spark, odd_rows())), model, keep=("doc_id", "kept", "score")).collect()
        assert len(out) == len(odd_rows()) and all(0 < r.score < 1 and r.kept == "x" for r in out)
    assert module.score_texts(docs(spark, []), model).count() == 0
    same = module.score_texts(docs(spark, [(1, None), (2, "")]), model).select(F.countDistinct("score")).first()[0]
    assert same == 1


def _labelled_many(spark, n, text):
    rows = [(i, text(i)) for i in range(n)]
    return docs(spark, rows), spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(n)], LABEL)


def test_every_labelled_text_is_in_one_shard_whatever_its_length_and_the_order(spark):
    d, labels = _labelled_many(spark, 900, lambda i: f"text {i} " * (i % 5 + 1) if i else "long " * 80_000)
    d = d.unionByName(d.filter("doc_id < 50")).unionByName(docs(spark, [(3, "another"), (4, None), (None, "x")]))
    got = []
    for rows in (d, d.orderBy(F.col("doc_id").desc())):
        texts = labelled_texts(rows, labels, "toxic", lambda c: F.lit(True))
        keep = lambda t: pa.RecordBatch.from_arrays(
            [pa.array([i]) for i in (t.column("_shard")[0].as_py(), ",".join(map(str, t.column("_id").to_pylist())))], ["s", "ids"])
        shards = per_shard(dealt(texts, 7), 7, keep, "s long, ids string").collect()
        got.append(sorted((r.s, r.ids) for r in shards))
    assert got[0] == got[1] and [s for s, _ in got[0]] == list(range(7))
    assert sorted(int(i) for _, ids in got[0] for i in ids.split(",")) == sorted([*range(900), 3])
    assert {k: n for k, (n, _) in totals(texts, F.lit(0)).items()} == {0: 676, 1: 225}


def test_fits_learn_what_only_few_of_many_labelled_texts_show(spark):
    """Words that a bounded draw of the labels would mostly miss."""
    d, labels = _labelled_many(spark, 1200, lambda i: "plain words " * 4 + (f"zzidot{i % 40} " if i % 4 == 0 else f"other{i % 40} ") + "more plain words")
    net = toxicity.fit(d, labels, toxicity.CnnParams(shard_rows=200, steps=60))
    rows = toxicity.score_texts(d, net).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in rows]) > 0.95
    d, labels = _labelled_many(spark, 1200, lambda i: f"Plain words number {i}, and some more of them.\n" if i % 3 else f"BUY!!! {i} $$$ {i}")
    model = quality.fit(d, labels, quality.RankParams(shard_rows=200))
    s, y = map(np.array, zip(*[(r.score, r.quality) for r in quality.score_texts(d, model).join(labels, "doc_id").collect()]))
    assert auc(s, y) > 0.99 and abs((s < 0.7).mean() - (y == 0).mean()) < 0.01


def test_weight_lines_can_be_put_back():
    net, other = toxicity.Cnn(small_cnn()), toxicity.Cnn(toxicity.CnnParams(**{**small_cnn().__dict__, "seed": 9}))
    lines = toxicity._flat(other)
    toxicity._put(net, np.arange(len(lines)), lines)
    assert all(np.array_equal(a, b) for a, b in zip([net.emb, *net.arrays()], [other.emb, *other.arrays()]))


def test_pairs_hold_every_text():
    good, bad = np.arange(50), np.arange(50, 60)
    a, b = quality._pairs(good, bad, quality.RankParams(pairs=12), True)
    assert len(a) == len(b) and set(a) == set(good) and set(b) == set(bad)
