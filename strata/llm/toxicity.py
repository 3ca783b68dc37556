"""Convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of table rows picked by hashes of the word and of its first
3, 4 and 5 bytes. Filters of widths 1, 2 and 3 slide over the word sequence, ReLU and a
maximum over the whole text follow, then a logistic layer. All labelled texts are dealt to
shards. The first one trains the network (Adam, in numpy, in a task); from there every
shard trains it on, and what each has learnt is averaged, weight by weight over the shards that moved
it. The score depends on the text alone; only the decision threshold is calibrated by
language, on the scores of all labelled texts.
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
from strata.llm._text import ALNUM, split_words


@dataclass(frozen=True)
class CnnParams:
    """The fit uses all labelled texts, in shards of about ``shard_rows`` texts and
    ``shard_bytes`` bytes. Toxic ones weigh at least ``toxic_share`` of all together. A step
    takes ``batch`` texts, fewer if they have more than ``step_words`` words; ``steps`` is the
    length of the first training."""

    shard_rows: int = 4096
    shard_bytes: int = 1 << 24
    toxic_share: float = 1 / 3
    step_words: int = 1 << 19
    word_buckets: int = 1 << 16
    prefix_buckets: int = 1 << 15
    dim: int = 8
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    steps: int = 240
    batch: int = 32
    rate: float = 0.01
    threshold: float = 0.7
    min_language: int = 30
    seed: int = 3


def word_ids(w, p: CnnParams) -> np.ndarray:
    """Rows of the embedding table, one line of four per word."""
    cols = [(w.hashes() % np.uint64(p.word_buckets)).astype(np.int32)]
    for n in (3, 4, 5):
        h = (w.hashes(prefix=n) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        cols.append((p.word_buckets + (h >> np.uint64(20)) % np.uint64(p.prefix_buckets)).astype(np.int32))
    return np.stack(cols, axis=1)


class Cnn:
    """The network's arrays; picklable, a few megabytes whatever the corpus."""

    def __init__(self, p: CnnParams):
        rng = np.random.default_rng(p.seed)
        self.p = p
        rows = p.word_buckets + p.prefix_buckets
        self.emb = (rng.standard_normal((rows, p.dim)) * 0.1).astype(np.float32)
        self.conv = [(rng.standard_normal((w * p.dim, p.filters)) * (0.5 / np.sqrt(w * p.dim))).astype(np.float32)
                     for w in p.widths]
        self.bias = [np.zeros(p.filters, np.float32) for _ in p.widths]
        self.out = (rng.standard_normal(len(p.widths) * p.filters) * 0.1).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.thresholds: dict[str, float] = {}
        self.fallback = p.threshold

    def arrays(self):
        return [*self.conv, *self.bias, self.out, self.out_bias]

    def _padded(self, ids: np.ndarray, counts: np.ndarray):
        """Embedded words with empty rows after every text, so no window crosses texts."""
        pad = max(self.p.widths)
        starts = np.concatenate(([0], np.cumsum(counts + pad)))
        x = np.zeros((starts[-1], self.p.dim), np.float32)
        offs = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(offs[-1]) + np.repeat(starts[:-1] - offs[:-1], counts)
        e = self.emb[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            e += self.emb[ids[:, k]]
        x[at] = e
        return x, starts, offs

    def features(self, ids: np.ndarray, counts: np.ndarray, positions: bool = False):
        """Pooled filter outputs per text (and where each maximum stands)."""
        x, starts, offs = self._padded(ids, counts)
        out, where = [], []
        d, f = self.p.dim, self.p.filters
        # One product for all filter rows; a filter's output is a sum of shifted columns.
        every = x @ np.concatenate([k.reshape(-1, d, f) for k in self.conv]).transpose(1, 0, 2).reshape(d, -1)
        col = 0
        for w, k, b in zip(self.p.widths, self.conv, self.bias):
            n = len(x) - w + 1
            a = every[:n, col:col + f].copy()
            for s in range(1, w):
                a += every[s:s + n, col + s * f:col + (s + 1) * f]
            col += w * f
            for s in range(1, w):  # windows that would reach into the next text
                at = starts[1:] - s
                a[at[at < n]] = -np.inf
            best = np.maximum.reduceat(a, starts[:-1], axis=0)
            out.append(np.maximum(best + b, 0))
            if positions:
                # the filter's maximum inside each text
                at = np.empty(best.shape, np.int64)
                for i, (s, e) in enumerate(zip(starts[:-1], starts[1:])):
                    at[i] = s + a[s:min(e, n)].argmax(axis=0)
                where.append(at)
        f = np.concatenate(out, axis=1)
        return (f, where, x, starts, offs) if positions else f

    def score(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.features(ids, counts) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -60, 60)))


def _encode(texts, p: CnnParams) -> list[np.ndarray]:
    out = []
    for w in split_words(texts, ALNUM):
        ids, offs = word_ids(w, p), w.offsets()
        out += [ids[offs[i]:offs[i + 1]] for i in range(len(w.counts))]
    return out


def train(texts: list[str], labels: list[int], p: CnnParams) -> Cnn:
    """Fit the network; without texts of both labels it stays at score 0.5."""
    return train_ids(_encode(pa.array(texts, pa.string()), p), labels, p)


def _steps(docs: list[np.ndarray], n: int, p: CnnParams, rng) -> list[np.ndarray]:
    """``n`` draws of texts, all of them once before any comes again, cut into steps."""
    order = np.concatenate([rng.permutation(len(docs)) for _ in range(-(-n // len(docs)))])[:n]
    words = np.array([len(docs[i]) for i in order])
    out, start, held = [], 0, 0
    for i, w in enumerate(words):
        if i > start and (i - start == p.batch or held + w > p.step_words):
            out.append(order[start:i])
            start, held = i, 0
        held += w
    return [*out, order[start:]]


def train_ids(docs: list[np.ndarray], labels: list[int], p: CnnParams, start: Cnn | None = None, draws: int | None = None,
              weights: tuple[float, float] = (1.0, 1.0)) -> Cnn:
    """``train`` on encoded texts; ``start`` is trained on, and changed, if given. ``draws``
    texts are taken (``steps`` batches), ``weights`` go by label."""
    net = start or Cnn(p)
    y = np.array(labels, np.float32)
    if start is None and len(set(labels)) < 2:
        net.out[:] = 0
        return net
    rng = np.random.default_rng(p.seed)
    weight = np.array(weights, np.float32)[y.astype(int)]
    params = net.arrays()
    m, v = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    em, ev = np.zeros_like(net.emb), np.zeros_like(net.emb)
    for step, own in enumerate(_steps(docs, draws or p.steps * p.batch, p, rng), 1):
        ids = np.concatenate([docs[i] for i in own])
        counts = np.array([len(docs[i]) for i in own])
        f, where, x, starts, offs = net.features(ids, counts, positions=True)
        pr = 1 / (1 + np.exp(-np.clip(f @ net.out + net.out_bias[0], -60, 60)))
        g = (weight[own] * (pr - y[own]) / len(own)).astype(np.float32)
        grads = {id(net.out): f.T @ g, id(net.out_bias): np.array([g.sum()], np.float32)}
        df = g[:, None] * net.out[None, :] * (f > 0)
        dx_at, dx_val = [], []
        for k, (w, conv, b) in enumerate(zip(p.widths, net.conv, net.bias)):
            d = df[:, k * p.filters:(k + 1) * p.filters]
            dk = np.zeros_like(conv)
            for o in range(w):
                at = where[k] + o
                rows = x[np.minimum(at, len(x) - 1)]  # texts x filters x dim
                part = slice(o * p.dim, (o + 1) * p.dim)
                dk[part] = np.einsum("tf,tfd->df", d, rows)
                dx_at.append(at.reshape(-1))
                dx_val.append((d[:, :, None] * conv[part].T[None]).reshape(-1, p.dim))
            grads[id(conv)], grads[id(b)] = dk, d.sum(axis=0)
        at, val = np.concatenate(dx_at), np.concatenate(dx_val)
        # positions of real words only, back to embedding rows
        doc = np.searchsorted(starts, at, side="right") - 1
        doc = np.minimum(doc, len(counts) - 1)
        pos = at - starts[doc]
        real = (pos < counts[doc]) & (np.abs(val).sum(axis=1) > 0)
        rows = ids[offs[doc[real]] + pos[real]]
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        uniq, inv = np.unique(rows.reshape(-1), return_inverse=True)
        ge = np.zeros((len(uniq), p.dim), np.float32)
        np.add.at(ge, inv, np.repeat(val[real], rows.shape[1] if len(rows) else 4, axis=0))
        em[uniq] = 0.9 * em[uniq] + 0.1 * ge
        ev[uniq] = 0.999 * ev[uniq] + 0.001 * ge * ge
        net.emb[uniq] -= p.rate * (em[uniq] / c1) / (np.sqrt(ev[uniq] / c2) + 1e-8)
        for i, a in enumerate(params):
            ga = grads[id(a)]
            m[i] = 0.9 * m[i] + 0.1 * ga
            v[i] = 0.999 * v[i] + 0.001 * ga * ga
            a -= p.rate * (m[i] / c1) / (np.sqrt(v[i] / c2) + 1e-8)
    return net


def best_threshold(scores: np.ndarray, labels: np.ndarray, default: float, counts: np.ndarray | None = None) -> float:
    """The cut with the fewest errors; in a range of equally good cuts the one nearest
    to ``default`` (so a clean separation keeps it). ``counts``: texts of each score."""
    counts = np.ones(len(scores), int) if counts is None else counts
    cuts = np.unique(np.concatenate((scores, [default, 1.0])))
    cuts = np.concatenate((cuts, (cuts[1:] + cuts[:-1]) / 2))
    errors = np.zeros(len(cuts), int)
    for label in (0, 1):
        at = np.argsort(scores[labels == label])
        below = np.concatenate(([0], np.cumsum(counts[labels == label][at])))[np.searchsorted(scores[labels == label][at], cuts)]
        errors += below if label == 1 else counts[labels == 0].sum() - below
    good = cuts[errors == errors.min()]
    return float(good[np.argmin(np.abs(good - default))])


def _flat(net: Cnn) -> np.ndarray:
    """All weights as lines of ``dim``: a line of the embedding table each, then the others."""
    rest = np.concatenate([a.reshape(-1) for a in net.arrays()])
    rest = np.concatenate((rest, np.zeros(-len(rest) % net.p.dim, np.float32)))
    return np.concatenate((net.emb, rest.reshape(-1, net.p.dim)))


def _put(net: Cnn, lines: np.ndarray, values: np.ndarray) -> None:
    flat = _flat(net)
    flat[lines] = values
    net.emb[:] = flat[:len(net.emb)]
    rest, at = flat[len(net.emb):].reshape(-1), 0
    for a in net.arrays():
        a[...] = rest[at:at + a.size].reshape(a.shape)
        at += a.size


def _train_on(net: Cnn, rows: DataFrame, shards: int, steps: int, weights: tuple[float, float]) -> None:
    """Train the network on in every shard and put the mean of each weight line over the
    shards that changed it; a shard takes all its texts, ``steps`` batches at least. A few
    megabytes reach the driver."""
    shared, p = rows.sparkSession.sparkContext.broadcast(net), net.p

    def learn(t):
        own = Cnn(p)
        before = _flat(shared.value)
        _put(own, np.arange(len(before)), before)
        docs = _encode(t.column("_text").combine_chunks(), p)
        train_ids(docs, t.column("_label").to_pylist(), p, own, max(steps * p.batch, len(docs)), weights)
        after = _flat(own)
        at = np.flatnonzero((after != before).any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(after[at, k]) for k in range(p.dim))],
                                          ["_at", *(f"_w{k}" for k in range(p.dim))])

    names = [f"_w{k}" for k in range(p.dim)]
    learnt = per_shard(rows, shards, learn, ", ".join(["_at int", *(f"{c} float" for c in names)]))
    mean = learnt.groupBy("_at").agg(*[F.avg(c).cast("float").alias(c) for c in names]).toArrow()
    if mean.num_rows:
        _put(net, mean.column("_at").to_numpy(), np.stack([mean.column(c).to_numpy() for c in names], axis=1))


def _calibrate(net: Cnn, rows: DataFrame, langs: tuple[str, ...]) -> None:
    """Thresholds from the scores of all rows, counted by language, label and score to four
    decimals: the counts of one language fit one group."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    p = net.p

    def score(batches):
        for b in batches:
            s = [shared.value.score(word_ids(w, p), w.counts) for w in split_words(b.column(0), ALNUM, 1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.concatenate(s) if s else np.zeros(0), 4)), *b.columns[1:]],
                                             ["_score", "_label", "_h", "_id", "_lang"])

    lang = F.coalesce(F.col(langs[0]), F.lit("")) if langs else F.lit("")
    scored = rows.select("_text", "_label", "_h", "_id", lang.alias("_lang")).mapInArrow(
        score, "_score double, _label int, _h long, _id long, _lang string")
    counted = (scored.dropDuplicates(["_id", "_label", "_h"]).groupBy("_lang", "_label", "_score")
                     .agg(F.count(F.lit(1)).alias("_n")))

    def cut(t: pa.Table) -> tuple[float | None, int]:
        y, n = t.column("_label").to_numpy(), t.column("_n").to_numpy()
        return (best_threshold(t.column("_score").to_numpy(), y, p.threshold, n) if len(set(y.tolist())) == 2 else None), int(n.sum())

    def of_language(t: pa.Table) -> pa.Table:
        c, n = cut(t)
        return pa.table({"_lang": t.column("_lang").slice(0, 1), "_cut": pa.array([c], pa.float64()), "_n": pa.array([n], pa.int64())})

    counted = written(counted, "calibration")
    every = cut(counted.groupBy("_label", "_score").agg(F.sum("_n").alias("_n")).toArrow())[0]
    net.fallback = p.threshold if every is None else every
    found = counted.groupBy("_lang").applyInArrow(of_language, "_lang string, _cut double, _n long")
    for r in found.filter(F.col("_cut").isNotNull() & (F.col("_n") >= p.min_language)).collect():
        net.thresholds[r["_lang"]] = r["_cut"]


def fit(docs: DataFrame, labels: DataFrame, p: CnnParams = CnnParams(), allowed=None, label_col: str = "toxic",
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Cnn:
    """Train on every labelled text and calibrate a threshold per language."""
    langs = (lang_col,) if lang_col in docs.columns else ()
    with passing_tables(docs.sparkSession):
        rows = labelled_texts(docs, labels, label_col, allowed or (lambda c: F.lit(True)), 2, id_col, text_col, langs)
        return _fitted(written(rows, "labelled"), p, langs)


def _fitted(rows: DataFrame, p: CnnParams, langs: tuple[str, ...]) -> Cnn:
    count = totals(rows, F.octet_length("_text"))
    net = Cnn(p)
    if len(count) < 2:
        net.out[:] = 0
        return net
    texts, size = (sum(v[k] for v in count.values()) for k in (0, 1))
    shards = max(1, -(-texts // p.shard_rows), -(-size // p.shard_bytes))
    weights = (1.0, max(1.0, count[0][0] * p.toxic_share / (1 - p.toxic_share) / count[1][0]))
    rows = dealt(rows, shards)
    _train_on(net, rows.filter("_shard = 0"), 1, p.steps, weights)
    if shards > 1:
        _train_on(net, rows, shards, 0, weights)
    _calibrate(net, rows, langs)
    return net


def score_texts(docs: DataFrame, net: Cnn, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` for every row, from the whole text.

    Null and empty texts have the score of a text without words. Repeated rows are each
    scored; an empty table gives no rows; an input column named ``score`` is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = tuple(c for c in keep if c != "score")
    shared = spark.sparkContext.broadcast(net)
    schema = StructType([*docs.select(*keep).schema.fields, StructField("score", DoubleType())])

    def run(batches):
        model = shared.value
        for batch in batches:
            s = [model.score(word_ids(w, model.p), w.counts) for w in split_words(batch.column("_t"), ALNUM, 1 << 18)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.concatenate(s) if s else np.zeros(0))], [*keep, "score"])

    return docs.select(*keep, F.col(text_col).alias("_t")).mapInArrow(run, schema)


def threshold_of(net: Cnn, lang):
    """Column: the calibrated threshold of a language, the overall one for others."""
    cut = F.lit(net.fallback)
    for code, t in sorted(net.thresholds.items()):
        cut = F.when(F.coalesce(lang, F.lit("")) == code, F.lit(t)).otherwise(cut)
    return cut
