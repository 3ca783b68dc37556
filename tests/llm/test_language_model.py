import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.language_model import TAIL, Gru, LmParams, Vocabulary, deal, log_likelihood, score_streams, segments, train_streams
from tests.llm.cases import SF, clashing, docs, odd_rows

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def vocab(n=7):
    z = np.zeros(TAIL, np.int64)
    h = np.arange(1, n + 1, dtype=np.uint64)
    c = np.arange(n, 0, -1).astype(np.int64)
    return Vocabulary(100, n + 1, 5, h, c, h, c, z + 3, z + 2)


def small(**k):
    return LmParams(head=7, class_size=3, hidden=5, dim=4, **k)


def test_the_symbols_of_a_state_sum_to_one():
    p = small()
    net = Gru(p, vocab())
    net.wc += np.random.default_rng(0).standard_normal(net.wc.shape).astype(np.float32)
    net.ww += np.random.default_rng(1).standard_normal(net.ww.shape).astype(np.float32)
    s = np.random.default_rng(2).standard_normal((1, p.hidden)).astype(np.float32)
    lp, _ = net.log_probs(np.repeat(s, net.symbols, 0), np.arange(net.symbols))
    assert np.exp(lp).sum() == pytest.approx(1, abs=1e-5)


def test_backpropagation_equals_numeric_gradients():
    rng = np.random.default_rng(3)
    p = small(window=6, rate=0.0)
    net = Gru(p, vocab())
    for a in net.arrays()[:7]:
        a += rng.standard_normal(a.shape).astype(np.float32) * 0.3
    tok = rng.integers(0, net.symbols, 12)
    s = deal(tok, np.array([6, 4, 2]), 2, net.symbols - 1)
    moments = {"t": 0, "m": [0] * 8, "v": [0] * 8}
    p2 = small(window=6, rate=0.0, clip=1e9)
    net.p = p2
    train_streams(net, s, moments)  # rate 0: only the moments change; one window holds all
    for i, a in enumerate(net.arrays()):
        flat, g = a.reshape(-1), (moments["m"][i] / 0.1).reshape(-1)
        for k in rng.choice(flat.size, min(6, flat.size), replace=False):
            if abs(flat[k]) > 1e3:
                continue
            old, e = flat[k], 1e-2
            flat[k] = old + e
            up = score_streams(net, s).sum()
            flat[k] = old - e
            down = score_streams(net, s).sum()
            flat[k] = old
            assert -(up - down) / (2 * e) / len(tok) == pytest.approx(g[k], abs=2e-3), (i, k)


def test_windows_and_streams_do_not_change_a_score():
    rng = np.random.default_rng(5)
    counts = np.array([9, 1, 30, 4, 17])
    tok = rng.integers(0, 40, counts.sum())
    ends = np.cumsum(counts)
    ref = None
    for window, n in ((1, 1), (7, 2), (64, 5)):
        net = Gru(small(window=window), vocab())
        net.wc += np.random.default_rng(0).standard_normal(net.wc.shape).astype(np.float32)
        s = deal(tok, counts, n, net.symbols - 1)
        lp = score_streams(net, s)
        own = [lp[s.doc_at[i]:s.doc_at[i] + counts[i]] for i in range(len(counts))]
        assert all((s.tok[s.doc_at[i]:s.doc_at[i] + counts[i]] == tok[ends[i] - counts[i]:ends[i]]).all() for i in range(len(counts)))
        ref = ref or own
        assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(ref, own))


def test_segments_keep_every_token_and_what_stood_before_it():
    rng = np.random.default_rng(6)
    counts = np.array([5, 1, 17, 8, 4])
    tok = rng.integers(0, 40, counts.sum())
    parts = segments(counts, 4)
    assert parts.tolist() == [4, 1, 1, 4, 4, 4, 4, 1, 4, 4, 4]
    s = deal(tok, parts, 3, 99, counts)
    assert s.fresh.sum() == len(parts) and sorted(s.tok.tolist()) == sorted(tok.tolist())
    before = np.concatenate(([99], tok[:-1]))
    before[np.cumsum(counts)[:-1]] = 99
    at = np.cumsum(parts) - parts
    for i, (a, n) in enumerate(zip(at, parts)):
        own = slice(s.doc_at[i], s.doc_at[i] + n)
        assert (s.tok[own] == tok[a:a + n]).all() and (s.inp[own] == before[a:a + n]).all()


def test_a_long_text_is_learnt_from_in_segments(spark):
    rows = [(1, "one two three four five " * 400)] + [(i, f"short text {i}") for i in range(2, 30)]
    out = log_likelihood(docs(spark, rows), F.lit(True), LmParams(known=100, head=50, segment=64)).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in out) and max(r.n_tokens for r in out) == 2001


def test_base_score_and_gain_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = d.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).alias("out")).collect()
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOW)) + [None] for r in rows}
    c = Counter(w for r in rows if not r.out for w in words[r.doc_id])
    n, v = sum(c.values()), len(c)
    # few known words, so that rare ones go through the join
    got = log_likelihood(d, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, LmParams(known=500, head=400)).collect()
    out = {r.doc_id for r in rows if r.out}
    for r in got:
        w = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9, abs=1e-6)
    held = [r for r in got if r.doc_id in out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_training_text_is_learnt_from_once(spark, monkeypatch):
    from strata.llm import language_model

    seen = []

    def spy(df, label, write=language_model.written):
        out = write(df, label)
        if label == "lm-replicas":
            seen.extend(r.n for r in out.select("n").collect())
        return out

    monkeypatch.setattr(language_model, "written", spy)
    rows = [(i, f"some words of text {i} " * (1 + i % 5)) for i in range(300)] + [(None, "no id"), (7, None)]
    out = log_likelihood(docs(spark, rows), F.lit(True), LmParams(known=100, head=50)).collect()
    assert sum(seen) == sum(r.n_tokens for r in out)


def test_odd_rows_and_no_training_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    p = LmParams(known=100, head=50)
    out = log_likelihood(df, F.col("doc_id").isNotNull(), p).collect()
    assert len(out) == len(odd_rows())
    assert all(math.isfinite(r.score) and r.score < 0 and r.base_score < 0 for r in out)
    assert all(r.n_tokens == 1 for r in out if r.doc_id in (3, 4, 6))
    blank = log_likelihood(df, F.lit(None).cast("boolean"), p).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in blank)
    assert log_likelihood(docs(spark, []), F.lit(True), p).count() == 0


def test_groups_of_many_tokens_are_scored_in_more_streams_with_the_same_scores():
    p = LmParams()
    most = p.score_streams * p.window * p.steps
    assert (p.score_width(most - 1), p.score_width(most)) == (p.score_streams, 2 * p.score_streams)
    rng = np.random.default_rng(8)
    net = Gru(small(window=6), vocab())
    sizes = rng.integers(1, 60, 40)
    tok = rng.integers(0, net.symbols, sizes.sum())
    few, many = (deal(tok, sizes, n, net.symbols - 1) for n in (4, 8))

    def per_text(s):
        c = np.concatenate(([0.0], np.cumsum(score_streams(net, s))))
        return c[s.doc_at + sizes] - c[s.doc_at]

    assert per_text(few) == pytest.approx(per_text(many), rel=1e-6)
