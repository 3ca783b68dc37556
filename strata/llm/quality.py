"""Quality scores from preference pairs: a Bradley-Terry ranking.

Every whole text becomes a vector of shape statistics (letters, symbols, repetition, lines,
local extremes over windows of words). All labelled texts are dealt to shards; in each, pairs
(preferred, other) are drawn so that every text meets another, and P(preferred beats other)
= sigmoid(score difference) is fitted by logistic loss on feature differences, so a document's
score is linear in its features. The weights are the mean of the shards'; feature quantiles
and the decision threshold, a quantile of the scores, are those of all labelled texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm._labelled import dealt, labelled_texts, per_shard, totals
from strata.llm._tables import passing_tables, prepare, written
from strata.llm._text import SPACED, slices, split_words, text_bytes

_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "bang", "bar", "mark", "other", "wide")
_WINDOW = 40
_BINS = 10


def _class_table() -> np.ndarray:
    t = np.full(256, _CLASSES.index("other"), np.uint8)
    for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)),
                        ("space", b" \t\r\x0b\x0c"), ("newline", b"\n"), ("stop", b".,;:"), ("bang", b"!?"),
                        ("bar", b"|/\\"), ("mark", b"#$%&*@^~=<>+"), ("wide", range(128, 256))):
        t[list(chars)] = _CLASSES.index(name)
    return t


_TABLE = _class_table()


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(values)))
    return (c[offs[1:]] - c[offs[:-1]]).astype(float)


def _window_max(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per text, the largest share of flagged words in any window of 40 words."""
    c = np.concatenate(([0], np.cumsum(flags)))
    n = len(flags)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    end = np.minimum(np.arange(n) + _WINDOW, offs[1:][text]) if n else np.zeros(0, int)
    share = (c[end] - c[np.arange(n)]) / _WINDOW
    out = np.zeros(len(offs) - 1)
    np.maximum.at(out, text, share)
    return out


def features(col) -> np.ndarray:
    """One line per text of an Arrow string column."""
    raw, boffs = text_bytes(col)
    parts = []
    for i, j in slices(boffs, 1 << 21):
        data, offs = raw[boffs[i]:boffs[j]], boffs[i:j + 1] - boffs[i]
        size = np.maximum(np.diff(offs), 1)
        kinds = _TABLE[data]
        line = [_sums(kinds == k, offs) / size for k in range(len(_CLASSES))]
        (w,) = split_words(col.slice(i, j - i), SPACED, max_bytes=1 << 62)
        woffs, h = w.offsets(), w.hashes()
        n = np.maximum(w.counts, 1)
        text = np.repeat(np.arange(j - i), w.counts)
        length = (w.ends - w.starts)
        upper = np.concatenate(([0], np.cumsum(kinds == 0)))
        odd = np.concatenate(([0], np.cumsum((kinds == 7) | (kinds == 8) | (kinds == 6))))
        shout = (upper[w.ends] - upper[w.starts]) > np.maximum(1, length // 2)
        marked = (odd[w.ends] - odd[w.starts]) > 0
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        order = np.lexsort((h, text))
        hs, ts = h[order], text[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
        distinct = _sums(new, woffs) / n
        runs = np.flatnonzero(new)
        top = np.zeros(j - i)
        np.maximum.at(top, ts[runs], np.diff(np.concatenate((runs, [len(hs)]))))
        # lines: hashed whole, repeated ones counted by their bytes
        cut = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate((offs[:-1], cut + 1)))
        starts = starts[starts < len(data)]
        line_of = np.searchsorted(offs, starts, side="right") - 1
        ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
        pos = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
        hc = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * (h >> np.uint64(7) | np.uint64(1)))))
        lh = hc[pos[1]] - hc[pos[0]]
        lorder = np.lexsort((lh, line_of))
        dup = np.zeros(len(lh), bool)
        a, b = lorder[1:], lorder[:-1]
        dup[a] = (lh[a] == lh[b]) & (line_of[a] == line_of[b]) & (pos[1][a] > pos[0][a])
        dup_bytes = np.bincount(line_of, weights=np.where(dup, ends - starts, 0), minlength=j - i) if len(lh) else np.zeros(j - i)
        lines = np.bincount(line_of, minlength=j - i) if len(lh) else np.zeros(j - i)
        line += [np.log1p(w.counts), _sums(length, woffs) / n, distinct, distinct + 0.08 * np.log1p(w.counts), top / n,
                 _sums(shout, woffs) / n, _sums(marked, woffs) / n, _sums(again, woffs) / n,
                 _sums(length == 1, woffs) / n, _sums(length > 14, woffs) / n, dup_bytes / size,
                 lines / n, _window_max(shout, woffs), _window_max(marked, woffs), _window_max(again, woffs),
                 _window_max(length == 1, woffs), _window_max(length > 9, woffs)]
        parts.append(np.stack(line, axis=1))
    return np.concatenate(parts) if parts else np.zeros((0, len(_CLASSES) + 17))


@dataclass(frozen=True)
class RankParams:
    """The fit uses all labelled texts, in shards of about ``shard_rows`` (more if a label is so
    rare that shards would lack it), and ``pairs`` preference pairs a shard, more if its
    texts are more."""

    shard_rows: int = 6000
    pairs: int = 60_000
    steps: int = 150
    rate: float = 0.5
    l2: float = 1e-4
    cut: float = 0.7
    seed: int = 5


@dataclass
class Ranking:
    """Bin edges, weights and the quantile threshold; a few kilobytes."""

    edges: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    cut: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Standardised features and, per feature, which of its quantiles they pass."""
        z = np.clip((x - self.centre) / self.scale, -5, 5)
        above = (x[:, :, None] > self.edges[None]).reshape(len(x), -1)
        return np.concatenate((z, above), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1); exactly ``cut`` at the threshold."""
        z = self.raw(x) - self.threshold + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _pairs(good: np.ndarray, bad: np.ndarray, p: RankParams, every: bool) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    if not every:
        return rng.choice(good, p.pairs), rng.choice(bad, p.pairs)
    n = max(p.pairs, len(good), len(bad))
    return tuple(np.concatenate([rng.permutation(v) for _ in range(-(-n // len(v)))])[:n] for v in (good, bad))


def _flat(d: int, p: RankParams) -> Ranking:
    return Ranking(np.zeros((d, _BINS - 1)), np.zeros(d), np.ones(d), np.zeros(d * _BINS), 0.0, p.cut)


def train(x: np.ndarray, y: np.ndarray, p: RankParams, base: Ranking | None = None) -> Ranking:
    """Fit the pair ranking; without texts of both labels all scores are equal. ``base`` gives
    edges and scales (those of ``x``, if there is none); every text is then in a pair."""
    d = x.shape[1]
    if len(x) == 0 or len(set(y.tolist())) < 2:
        return _flat(d, p)
    if base is None:
        edges = np.quantile(x, np.arange(1, _BINS) / _BINS, axis=0).T
        model = Ranking(edges, x.mean(0), x.std(0) + 1e-9, np.zeros(d * _BINS), 0.0, p.cut)
    else:
        model = Ranking(base.edges, base.centre, base.scale, np.zeros(d * _BINS), 0.0, p.cut)
    e = model.expand(x)
    diff_at = _pairs(np.flatnonzero(y == 1), np.flatnonzero(y == 0), p, base is not None)
    w, grad_sq = model.weights, np.full(e.shape[1], 1e-8)
    for _ in range(p.steps):
        s = e @ w
        lose = 1 / (1 + np.exp(np.clip(s[diff_at[0]] - s[diff_at[1]], -60, 60)))
        # gradient of -log sigmoid(difference), gathered per text
        g = np.bincount(diff_at[0], lose, len(x)) - np.bincount(diff_at[1], lose, len(x))
        grad = -(g @ e) / len(diff_at[0]) + p.l2 * w
        grad_sq += grad * grad
        w -= p.rate * grad / np.sqrt(grad_sq)
    s = e @ w
    # the quantile at which the share of unpreferred texts lies below
    order, share = np.sort(s), (y == 0).mean()
    k = int(np.clip(round(share * len(s)), 1, len(s) - 1))
    model.threshold = float((order[k - 1] + order[k]) / 2)
    return model


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scales(rows: DataFrame, width: int, p: RankParams) -> Ranking:
    """Edges, centres and scales of all rows; the quantiles lie within 1/10000 of their ranks."""
    cuts = F.array(*[F.lit(k / _BINS) for k in range(1, _BINS)])
    x = [F.col("_x")[i] for i in range(width)]
    got = rows.agg(F.array(*[F.avg(v) for v in x]), F.array(*[F.stddev_pop(v) for v in x]),
                   F.array(*[F.percentile_approx(v, cuts, 10_000) for v in x])).first()
    return Ranking(np.array(got[2], float), np.array(got[0], float), np.array(got[1], float) + 1e-9,
                   np.zeros(width * _BINS), 0.0, p.cut)


def _threshold(rows: DataFrame, model: Ranking, n: int, share: float) -> float:
    """Between the two scores of all labelled texts that ``share`` of them lie below."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.raw(_matrix(b.column(0))))], ["_s"])

    k = int(np.clip(round(share * n), 1, n - 1))
    at = F.array(F.lit((k - 0.5) / n), F.lit((k + 0.5) / n))
    got = rows.select("_x").mapInArrow(run, "_s double").agg(F.percentile_approx("_s", at, 100_000)).first()[0]
    return float(sum(got) / 2)


def fit(docs: DataFrame, labels: DataFrame, p: RankParams = RankParams(), allowed=None, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Fit on every labelled text: only sums, quantiles and mean weights reach the driver."""
    width = features(pa.array([], pa.string())).shape[1]
    texts = labelled_texts(docs, labels, label_col, allowed or (lambda c: F.lit(True)), 2, id_col, text_col)

    def encode(batches):
        for b in batches:
            x = pa.FixedSizeListArray.from_arrays(pa.array(features(b.column(3)).reshape(-1)), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), x], ["_id", "_label", "_h", "_x"])

    with passing_tables(docs.sparkSession):
        rows = texts.mapInArrow(encode, "_id long, _label int, _h long, _x array<double>")
        return _fitted(written(rows.dropDuplicates(["_id", "_label", "_h"]), "labelled"), width, p)


def _fitted(rows: DataFrame, width: int, p: RankParams) -> Ranking:
    count = {k: n for k, (n, _) in totals(rows, F.lit(0)).items()}
    if len(count) < 2:
        return _flat(width, p)
    n = sum(count.values())
    # a shard's rarer label has sixteen texts or more as a rule
    shards = max(1, min(-(-n // p.shard_rows), min(count.values()) // 16))
    model = _scales(rows, width, p)

    def learn(t):
        w = train(_matrix(t.column("_x")), t.column("_label").to_numpy(), p, model).weights
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(w), dtype=np.int32)), pa.array(w)], ["_at", "_w"])

    learnt = per_shard(dealt(rows, shards), shards, learn, "_at int, _w double")
    for r in learnt.groupBy("_at").agg(F.avg("_w").alias("_w")).collect():
        model.weights[r["_at"]] = r["_w"]
    model.threshold = _threshold(rows, model, n, count[0] / n)
    return model


def score_texts(docs: DataFrame, model: Ranking, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` for every row, from the whole text.

    Null and empty texts have the score of an empty text. Repeated rows are each scored;
    an empty table gives no rows; an input column named ``score`` is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = tuple(c for c in keep if c != "score")
    shared = spark.sparkContext.broadcast(model)
    schema = StructType([*docs.select(*keep).schema.fields, StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            s = shared.value.score(features(batch.column("_t")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(s)], [*keep, "score"])

    return docs.select(*keep, F.col(text_col).alias("_t")).mapInArrow(run, schema)
