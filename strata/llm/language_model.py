"""A gated recurrent language model with a class-factored output softmax.

Counts of all words of all training texts come first; they give the base model, the
vocabulary and the classes:

* the ``head`` most frequent words sit in classes of ``class_size`` words of similar
  frequency. P(word | state) = P(class | state) * P(word | class, state);
* all other words, unknown ones included, are spread over a few tail classes by their
  outer shape. Inside a tail class the counts decide: (c + 1) / (N_k + V_k + 1);
* the end of a text is a class of its own.

The network (embeddings, GRU, output layers) is trained in numpy by truncated
backpropagation. Every task trains a replica on its share of the round's texts, the
replicas are averaged, and the next round goes on from the average with other texts; the
rounds together make one pass over all training texts. To
score a text its state is carried from window to window over the whole text, so the score
is the log-likelihood of the complete document.

Counts of the ``known`` most frequent words travel with the model; those of the rarer
words of a text are joined.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._labelled import fold
from strata.llm._tables import most_frequent, prepare, written
from strata.llm._text import SPACED, HashTable, split_words

END = -1  # the end-of-text token's key in the count table
TAIL = 32
TILE = 32  # places of one class in a tile of the words' softmax


@dataclass(frozen=True)
class LmParams:
    """``rounds`` rounds of training, each over another ``1/rounds`` of all training texts,
    by hash, so every text is learnt from once; ``streams`` texts at a time, more where a task has
    many tokens (so that it still makes ``steps`` steps, at most ``most_streams``), ``window``
    tokens of backpropagation. Texts of more than ``segment`` tokens are learnt from in segments,
    so the end of a long text is no lonely stream; to be scored they stay whole."""

    head: int = 2000
    class_size: int = 40
    known: int = 1 << 18
    hidden: int = 16
    dim: int = 16
    rounds: int = 3
    window: int = 32
    streams: int = 32
    most_streams: int = 128
    steps: int = 128
    score_streams: int = 128
    segment: int = 2048
    group_words: int = 1 << 21
    score_words: int = 3 << 20
    rate: float = 0.01
    clip: float = 1.0
    seed: int = 1

    def width(self, tokens: int) -> int:
        """Streams for a task's tokens."""
        return max(self.streams, min(self.most_streams, tokens // (self.window * self.steps)))

    def score_width(self, tokens: int) -> int:
        """Streams to score a group's tokens in; any number gives the same scores."""
        return self.score_streams * (2 if tokens >= self.score_streams * self.window * self.steps else 1)


def shape_class(w, at=slice(None)) -> np.ndarray:
    """Tail class of every word (or of those ``at`` some places): its last character's kind,
    plain or not, its length."""
    starts, ends = w.starts[at], w.ends[at]
    last = w.data[ends - 1]
    kind = _LAST[last]
    wide = np.concatenate(([0], np.cumsum(w.data >= 128, dtype=np.int32)))
    plain = (wide[ends] == wide[starts]).astype(int)
    size = np.digitize(ends - starts, (5, 9, 13))
    return kind * 8 + plain * 4 + size


#: Kind of a last byte: full stop, comma, letter or digit or beyond ASCII, another.
_LAST = np.array([0 if c == 46 else 1 if c == 44 else 2 if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 3 for c in range(256)])


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(h, cls, c)`` over all texts: counts per word, the end of a text under END."""
    prepare(docs.sparkSession)

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ends = 0

        def merged():
            h, c, n = (np.concatenate(x) for x in zip(*held))
            u, at, inv = np.unique(h, return_index=True, return_inverse=True)
            return u, c[at], np.bincount(inv, weights=n).astype(np.int64)

        def rows(h, c, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(n)],
                                              ["h", "cls", "c"])

        for batch in batches:
            ends += batch.num_rows
            for w in split_words(batch.column(0), SPACED):
                h = w.hashes()
                if not len(h):
                    continue
                by = np.argsort(h)  # any of a word's places tells its class
                h = h[by]
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                held.append((h[first], shape_class(w, by[first]), np.diff(np.append(first, len(h)))))
            if sum(len(x[0]) for x in held) > 1 << 21:
                held = [merged()]
                if len(held[0][0]) > 1 << 20:
                    yield rows(*held[0])
                    held = []
        if held:
            yield rows(*merged())
        yield rows(np.array([END], np.int64), np.array([TAIL]), np.array([ends]))

    return (docs.select(text_col).mapInArrow(count, "h long, cls int, c long")
                .groupBy("h", "cls").agg(F.sum("c").alias("c")).filter("c > 0"))


@dataclass
class Vocabulary:
    """What the counts say; arrays bounded by ``head`` and ``known``."""

    tokens: int            # N
    types: int             # V
    end_count: int
    head: np.ndarray       # word hashes by falling count
    head_counts: np.ndarray
    known: np.ndarray
    known_counts: np.ndarray
    tail_tokens: np.ndarray
    tail_types: np.ndarray

    def tables(self):
        return HashTable(self.head), HashTable(self.known)


def vocabulary(counts: DataFrame, p: LmParams) -> Vocabulary:
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    words = counts.filter(F.col("cls") < TAIL)
    end = counts.filter(F.col("cls") == TAIL).agg(F.sum("c")).first()[0] or 0
    top = most_frequent(words, "c", p.known).toPandas()  # at most ``known`` rows of three numbers
    top = top.sort_values(["c", "h"], ascending=[False, True], ignore_index=True)
    head = top.iloc[:p.head]
    per = {r["cls"]: (r["n"], r["v"]) for r in words.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n = np.array([per.get(k, (0, 0))[0] for k in range(TAIL)], np.int64)
    v = np.array([per.get(k, (0, 0))[1] for k in range(TAIL)], np.int64)
    cls = head["cls"].to_numpy().astype(np.int64)
    n -= np.bincount(cls, weights=head["c"], minlength=TAIL).astype(np.int64)
    v -= np.bincount(cls, minlength=TAIL)
    return Vocabulary(int(totals[0] or 0), int(totals[1]), int(end),
                      head["h"].to_numpy().astype(np.int64).view(np.uint64), head["c"].to_numpy().astype(np.int64),
                      top["h"].to_numpy().astype(np.int64).view(np.uint64), top["c"].to_numpy().astype(np.int64), n, v)


#: exp() of numbers up to this size, and sums of them, are exact enough in 32 bits as they are.
SAFE = 60.0


def _reach(w: np.ndarray, b: np.ndarray, axis: int) -> float:
    """Bound of ``|s @ w + b|`` for states ``s`` between -1 and 1."""
    return float((np.abs(w).sum(axis) + np.abs(b)).max()) if b.size else 0.0


def _by(keys: np.ndarray, bound: int) -> np.ndarray:
    """Stable order of whole numbers below ``bound`` (16-bit keys are sorted by counting)."""
    return np.argsort(keys.astype(np.int16) if bound < 1 << 15 else keys, kind="stable")


class Gru:
    """The network. Tokens: head words 0.., then the tail classes, then the end."""

    def __init__(self, p: LmParams, vocab: Vocabulary):
        rng = np.random.default_rng(p.seed)
        self.p = p
        self.n_head = len(vocab.head)
        size = p.class_size
        self.head_classes = -(-self.n_head // size)
        self.classes = self.head_classes + TAIL + 1
        self.symbols = self.n_head + TAIL + 1  # the end symbol is the input before a text
        f = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.emb = f(self.symbols, p.dim)
        self.wx, self.wh = f(p.dim, 3 * p.hidden), f(p.hidden, 3 * p.hidden)
        self.b = np.zeros(3 * p.hidden, np.float32)
        self.wc = np.zeros((p.hidden, self.classes), np.float32)
        self.ww = np.zeros((self.head_classes, p.hidden, size), np.float32)
        # biases start at the counts: before training the model is the class unigram
        c = np.zeros(self.head_classes * size)
        c[:self.n_head] = vocab.head_counts
        c = c.reshape(self.head_classes, size)
        with np.errstate(divide="ignore"):
            self.bw = np.log(c / np.maximum(c.sum(1, keepdims=True), 1)).astype(np.float32)
        self.bw[~np.isfinite(self.bw)] = -1e4  # unused places of the last class
        mass = np.concatenate((c.sum(1), vocab.tail_tokens + vocab.tail_types * 0.1 + 1, [vocab.end_count + 1]))
        self.bc = np.log(mass / mass.sum()).astype(np.float32)

    def arrays(self) -> list[np.ndarray]:
        return [self.emb, self.wx, self.wh, self.b, self.wc, self.bc, self.ww, self.bw]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.reshape(-1) for a in self.arrays()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for a in self.arrays():
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size

    def class_of(self, tok: np.ndarray) -> np.ndarray:
        return np.where(tok < self.n_head, tok // self.p.class_size, tok - self.n_head + self.head_classes)

    def run(self, gates_in: np.ndarray, h: np.ndarray, fresh: np.ndarray, saved: tuple[np.ndarray, ...] | None = None):
        """States of one window: ``gates_in`` (steps, streams, 3 hidden), those of z and r halved
        (``halved``); ``fresh`` marks steps that begin a text, where the state starts at zero. ``saved``
        takes what backpropagation needs, step by step: states before, z, r and the candidate's
        recurrent part side by side, candidates."""
        n = self.p.hidden
        steps, streams = gates_in.shape[:2]
        out = np.empty((steps, streams, n), np.float32)
        begins = fresh.any(1).tolist()
        wh = self.halved(self.wh)  # sigmoid(x) = tanh(x/2)/2 + 1/2
        before, gates, cand = saved or (None, np.empty((1, streams, 3 * n), np.float32), np.empty((1, streams, n), np.float32))
        half = np.float32(0.5)
        step = np.empty((streams, n), np.float32)
        for t in range(steps):
            if begins[t]:
                h = h * ~fresh[t][:, None]
            k = 0 if saved is None else t
            if saved is not None:
                before[t] = h
            a, c = gates[k], cand[k]
            np.matmul(h, wh, out=a)
            zr = a[:, :2 * n]
            zr += gates_in[t, :, :2 * n]
            np.tanh(zr, out=zr)
            zr *= half
            zr += half
            np.multiply(a[:, n:2 * n], a[:, 2 * n:], out=c)
            c += gates_in[t, :, 2 * n:]
            np.tanh(c, out=c)
            np.subtract(c, h, out=step)
            step *= a[:, :n]
            h = np.add(h, step, out=out[t])
        return out, h

    def halved(self, gates: np.ndarray) -> np.ndarray:
        """A copy with the columns of z and r halved."""
        gates = gates.copy()
        gates[..., :2 * self.p.hidden] *= np.float32(0.5)
        return gates

    def log_probs(self, s: np.ndarray, tok: np.ndarray, grads: list[np.ndarray] | None = None):
        """Natural log P(token | state) (tail words: of their class); with ``grads`` the
        output layers' gradients are added there and the states' gradient is returned.

        The words' softmax runs over tiles: ``TILE`` places of one class each, so all classes
        go through one product whatever their share of the tokens."""
        cls = self.class_of(tok)
        z = s @ self.wc
        z += self.bc
        if _reach(self.wc, self.bc, 0) > SAFE:
            z -= z.max(1, keepdims=True)
        at = np.arange(len(tok))
        out = z[at, cls]
        e = np.exp(z, out=z)
        tot = e @ np.ones(self.classes, np.float32)
        out = out - np.log(tot)
        ds = None
        if grads is not None:
            e /= tot[:, None]
            e[at, cls] -= 1
            ds = e @ self.wc.T
            grads[4] += s.T @ e
            grads[5] += np.ones(len(e), np.float32) @ e
        order = _by(cls, self.classes)
        per = np.bincount(cls, minlength=self.classes)[:self.head_classes]
        head = order[:per.sum()]
        if len(head):
            tiles = -(-per // TILE)
            first = np.cumsum(tiles) - tiles
            own = cls[head]
            place = np.arange(len(head)) - (np.cumsum(per) - per)[own] + first[own] * TILE
            kinds = np.repeat(np.arange(self.head_classes), tiles)
            x = np.zeros((len(kinds) * TILE, self.p.hidden), np.float32)
            x[place] = s[head]
            x = x.reshape(len(kinds), TILE, -1)
            ww = self.ww[kinds]
            y = np.matmul(x, ww)
            y += self.bw[kinds][:, None, :]
            if _reach(self.ww, np.where(self.bw > -1e3, self.bw, 0), 1) > SAFE:
                y -= y.max(2, keepdims=True)
            w = tok[head] - own * self.p.class_size
            size = self.p.class_size
            picked = y.reshape(-1, size)[place, w]
            e = np.exp(y, out=y)
            tot = (e.reshape(-1, size) @ np.ones(size, np.float32)).reshape(e.shape[:2])
            out[head] += picked - np.log(tot.reshape(-1)[place])
            if grads is not None:
                used = np.zeros(len(kinds) * TILE, np.float32)
                used[place] = 1
                e *= (used.reshape(tot.shape) / tot)[:, :, None]  # empty places have no gradient
                e.reshape(-1, size)[place, w] -= 1
                ds[head] += np.matmul(e, ww.transpose(0, 2, 1)).reshape(-1, self.p.hidden)[place]
                there = np.flatnonzero(tiles)
                grads[6][there] += np.add.reduceat(np.matmul(x.transpose(0, 2, 1), e), first[there], axis=0)
                grads[7][there] += np.add.reduceat(e.sum(1), first[there], axis=0)
        return out, ds


@dataclass
class Streams:
    """Texts dealt to parallel streams, longest first, each stream one sequence."""

    tok: np.ndarray      # tokens, stream after stream
    inp: np.ndarray      # the token before each (the end symbol at a text's start)
    fresh: np.ndarray
    starts: np.ndarray   # of streams, longest stream first
    sizes: np.ndarray
    doc_at: np.ndarray   # where each text begins in ``tok``


def segments(counts: np.ndarray, most: int) -> np.ndarray:
    """Sizes of the texts' segments of at most ``most`` tokens, in order."""
    per = -(-counts // most)
    out = np.full(per.sum(), most, counts.dtype)
    out[np.cumsum(per) - 1] = counts - (per - 1) * most
    return out


def deal(tok: np.ndarray, counts: np.ndarray, n: int, bos: int, texts: np.ndarray | None = None) -> Streams:
    """``tok``: the texts' tokens one after the other, ``counts`` tokens each (>= 1); with
    ``texts`` (tokens of each text) ``counts`` are of their segments."""
    n = max(1, min(n, len(counts)))
    heap = [(0, i) for i in range(n)]
    lists: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-counts, kind="stable").tolist():
        size, i = heap[0]
        lists[i].append(d)
        heapq.heapreplace(heap, (size + int(counts[d]), i))
    sizes = np.array([int(counts[x].sum()) if x else 0 for x in lists], np.int64)
    by = np.argsort(-sizes, kind="stable")
    order = np.array([d for i in by for d in lists[i]], np.int64)
    offs = np.concatenate(([0], np.cumsum(counts)))
    doc_at = np.empty(len(counts), np.int64)
    doc_at[order] = np.concatenate(([0], np.cumsum(counts[order])))[:-1]
    src = np.repeat((offs[:-1][order] - doc_at[order]).astype(np.int32), counts[order])  # a group is far below 2**31 tokens
    src += np.arange(offs[-1], dtype=np.int32)
    own = tok[src]
    fresh = np.zeros(len(own), bool)
    fresh[doc_at] = True
    before = np.roll(tok, 1)
    before[offs[:-1] if texts is None else np.cumsum(texts) - texts] = bos
    inp = before[src]
    sizes = sizes[by]
    return Streams(own, inp, fresh, np.concatenate(([0], np.cumsum(sizes)))[:-1], sizes, doc_at)


def _windows(s: Streams, window: int):
    """``(positions (steps, streams) clipped to their stream, live mask, active streams)``."""
    for t in range(0, int(s.sizes[0]) if len(s.sizes) else 0, window):
        active = int(np.searchsorted(-s.sizes, -t, side="left"))
        steps = min(window, int(s.sizes[0]) - t)
        at = t + np.arange(steps)[:, None]
        live = at < s.sizes[:active]
        yield s.starts[:active] + np.minimum(at, s.sizes[:active] - 1), live, active


def score_streams(net: Gru, s: Streams) -> np.ndarray:
    """Natural log-probability of every token, the state carried through each text."""
    out = np.zeros(len(s.tok))
    table = net.halved(net.emb @ net.wx + net.b)  # input projections of all symbols
    h = np.zeros((len(s.sizes), net.p.hidden), np.float32)
    for at, live, active in _windows(s, net.p.window):
        states, h = net.run(table[s.inp[at]], h[:active], s.fresh[at] & live)
        places = at[live]
        out[places], _ = net.log_probs(states[live], s.tok[places])
    return out


def train_streams(net: Gru, s: Streams, moments, rate: float | None = None, width: int | None = None) -> None:
    """Adam steps over the streams, window by window, gradients cut at window edges.

    A step is as long as its share of the tokens of a full window of ``width`` streams: where
    few streams are left, the end of one long text does not move the model as far as many
    texts do. The rate grows with the root of the width, as the gradients' noise falls.
    """
    p = net.p
    n = p.hidden
    width = width or p.streams
    rate = (p.rate if rate is None else rate) * math.sqrt(width / p.streams)
    params = net.arrays()
    h = np.zeros((len(s.sizes), n), np.float32)
    grads = [np.zeros_like(a) for a in params]
    for at, live, active in _windows(s, p.window):
        fresh = s.fresh[at] & live
        begins = fresh.any(1)
        inp = s.inp[at]
        x = net.emb[inp]
        gates_in = x @ net.wx + net.b
        gates_in[:, :, :2 * n] *= np.float32(0.5)
        prev, gates, c = (np.empty((*at.shape, k * n), np.float32) for k in (1, 3, 1))
        states, h = net.run(gates_in, h[:active], fresh, (prev, gates, c))
        for g in grads:
            g.fill(0)
        _, dl = net.log_probs(states[live], s.tok[at[live]], grads)
        ds = np.zeros_like(states)
        ds[live] = dl
        dh = np.zeros((active, n), np.float32)
        z, r, ac = gates[:, :, :n], gates[:, :, n:2 * n], gates[:, :, 2 * n:]
        keep = 1 - z
        to_z, to_c, to_r = (c - prev) * z * keep, z * (1 - c * c), ac * r * (1 - r)
        da = np.empty((*inp.shape, 3 * n), np.float32)  # of the recurrent gates
        dcs = np.empty((*inp.shape, n), np.float32)
        back = np.empty((active, n), np.float32)
        for t in range(len(at) - 1, -1, -1):
            dh += ds[t]
            g, dc = da[t], dcs[t]
            np.multiply(dh, to_z[t], out=g[:, :n])
            np.multiply(dh, to_c[t], out=dc)
            np.multiply(dc, to_r[t], out=g[:, n:2 * n])
            np.multiply(dc, r[t], out=g[:, 2 * n:])
            dh *= keep[t]
            dh += np.matmul(g, net.wh.T, out=back)
            if begins[t]:
                dh *= ~fresh[t][:, None]
        grads[2] += prev.reshape(-1, n).T @ da.reshape(-1, 3 * n)
        dg = da  # of the input gates: they differ in the candidate's
        dg[:, :, 2 * n:] = dcs
        flat = dg.reshape(-1, 3 * n)
        grads[1] += x.reshape(-1, p.dim).T @ flat
        grads[3] += flat.sum(0)
        symbol = inp.reshape(-1)
        by = _by(symbol, net.symbols)
        first = np.flatnonzero(np.diff(symbol[by], prepend=-1))
        grads[0][symbol[by[first]]] = np.add.reduceat((flat @ net.wx.T)[by], first, axis=0)
        norm = live.sum()
        moments["t"] += 1
        c1, c2 = 1 - 0.9 ** moments["t"], 1 - 0.99 ** moments["t"]
        step = rate * norm / (width * p.window)
        size = math.sqrt(sum(float(np.vdot(g, g)) for g in grads)) / norm
        scale = np.float32(min(1.0, p.clip / max(size, 1e-12)) / norm)
        for i, (a, g) in enumerate(zip(params, grads)):
            g *= scale
            moments["m"][i] = m = np.float32(0.9) * moments["m"][i] + np.float32(0.1) * g
            moments["v"][i] = v = np.float32(0.99) * moments["v"][i] + np.float32(0.01) * g * g
            div = np.sqrt(v)
            div *= np.float32(1 / math.sqrt(c2))
            div += np.float32(1e-6)
            np.divide(m, div, out=div)
            div *= np.float32(step / c1)
            a -= div


def tokens_of(w, head: HashTable, n_head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a slice's texts, each text closed by the end symbol; symbols per text;
    the hashes of its words."""
    h = w.hashes()
    sym = head.find(h).astype(np.int32)
    rare = np.flatnonzero(sym < 0)
    sym[rare] = n_head + shape_class(w, rare)
    offs = w.offsets()
    return np.insert(sym, offs[1:], n_head + TAIL).astype(np.int32), w.counts + 1, h


def train(docs: DataFrame, vocab: Vocabulary, p: LmParams, text_col: str, pick_col: str) -> Gru:
    """Average of replicas, round by round. ``docs``: the training texts."""
    spark = docs.sparkSession
    prepare(spark)
    net = Gru(p, vocab)
    for rnd in range(p.rounds):
        # every text falls into one part, whatever its length or source
        part = F.pmod(F.xxhash64(F.lit(p.seed), F.col(pick_col), F.length(text_col)), F.lit(p.rounds))
        own = docs.filter(part == rnd).select(text_col)
        shared = spark.sparkContext.broadcast((net, vocab.head))
        rate = p.rate * (p.rounds - rnd) / p.rounds  # falls over the pass

        def fit(batches):
            base, head_words = shared.value
            mine = Gru.__new__(Gru)
            mine.__dict__ = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in base.__dict__.items()}
            table = HashTable(head_words)
            moments = {"t": 0, "m": [0] * 8, "v": [0] * 8}
            seen, toks, counts = 0, [], []

            def go():
                tok, sizes = np.concatenate(toks), np.concatenate(counts)
                width = p.width(len(tok))
                train_streams(mine, deal(tok, segments(sizes, p.segment), width, mine.symbols - 1, sizes), moments, rate, width)
                toks.clear()
                counts.clear()

            for batch in batches:
                for w in split_words(batch.column(0), SPACED):
                    tok, n, _ = tokens_of(w, table, mine.n_head)
                    toks.append(tok)
                    counts.append(n)
                    seen += len(tok)
                    if sum(map(len, toks)) >= p.group_words:
                        go()
            if toks:
                go()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array(
                    [(mine.flat().astype(np.float64) * seen).tobytes()], pa.binary())], ["n", "w"])

        def add(batches):
            n, total = 0, None
            for batch in batches:
                for k, w in zip(batch.column(0).to_pylist(), batch.column(1)):
                    v = np.frombuffer(w.as_py(), np.float64)
                    n, total = n + k, v.copy() if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "w"])

        replicas = written(own.mapInArrow(fit, "n long, w binary"), "lm-replicas")
        # Sums of about sqrt(replicas) replicas each reach the driver, of fixed size.
        groups = max(1, math.isqrt(replicas.count()))
        sums = replicas.repartition(groups).mapInArrow(add, "n long, w binary").collect()
        if sums:
            n = sum(r["n"] for r in sums)
            net.load((sum(np.frombuffer(r["w"], np.float64) for r in sums) / n).astype(np.float32))
    return net


def log_likelihood(docs: DataFrame, training, p: LmParams = LmParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``training``: boolean column of the rows to learn from. Scores are log10
    probabilities of the whole text and its end; ``base_score`` is the add-one unigram's.
    Null and empty texts consist of their end. Repeated rows are each learnt from and
    scored; an empty table gives no rows; without training texts every word is unknown.
    Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                         F.coalesce(training, F.lit(False)).alias("_train"))
    learn = source.filter("_train")
    counts = written(word_counts(learn, "t"), "lm-counts")
    vocab = vocabulary(counts, p)
    net = train(learn, vocab, p, "t", "doc_id")
    shared = spark.sparkContext.broadcast((net, vocab))

    def score(batches):
        model, v = shared.value
        head, known = v.tables()
        known_log = np.log10(v.known_counts + 1.0)
        tail_log = np.log10(v.tail_tokens + v.tail_types + 1.0)
        end_log = math.log10(v.end_count + 1.0)
        ids, toks, counts_, hashes = [], [], [], []

        def go():
            tok, n, h = np.concatenate(toks), np.concatenate(counts_), np.concatenate(hashes)
            s = deal(tok, n, p.score_width(len(tok)), model.symbols - 1)
            lp = score_streams(model, s) / math.log(10)
            in_tail = np.flatnonzero((s.tok >= model.n_head) & (s.tok < model.n_head + TAIL))
            lp[in_tail] -= tail_log[s.tok[in_tail] - model.n_head]
            # texts back in their order
            cum = np.concatenate(([0.0], np.cumsum(lp)))
            model_part = cum[s.doc_at + n] - cum[s.doc_at]
            del s, lp, cum, in_tail
            words = n - 1
            offs = np.concatenate(([0], np.cumsum(words)))
            sym = np.delete(tok, np.cumsum(n) - 1)
            at = sym.copy()  # the head words come first among the known ones
            rare = np.flatnonzero(sym >= model.n_head)
            at[rare] = known.find(h[rare])
            seen = at >= 0
            logs = np.zeros(len(h))
            logs[seen] = known_log[at[seen]]

            def per_doc(x):
                c = np.concatenate(([0.0], np.cumsum(x)))
                return c[offs[1:]] - c[offs[:-1]]

            model_part += per_doc(np.where(sym >= model.n_head, logs, 0.0))
            doc = np.repeat(np.arange(len(n), dtype=np.int32), words)
            rare_doc, rare_h = doc[~seen], h[~seen]
            order = np.lexsort((rare_h, rare_doc))
            rare_doc, rare_h = rare_doc[order], rare_h[order]
            new = np.ones(len(rare_h), bool)
            new[1:] = (rare_h[1:] != rare_h[:-1]) | (rare_doc[1:] != rare_doc[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.concatenate((first, [len(rare_h)])))
            lists = np.searchsorted(rare_doc[first], np.arange(len(n) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(n.astype(np.int64)),
                 pa.array(per_doc(seen).astype(np.int64) + int(v.end_count > 0)),
                 pa.array(per_doc(logs) + end_log), pa.array(model_part),
                 pa.ListArray.from_arrays(pa.array(lists), pa.array(rare_h[first].view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(lists), pa.array(times.astype(np.int32)))],
                ["doc_id", "n_tokens", "n_known", "logs", "model", "rare", "times"])
            for x in (ids, toks, counts_, hashes):
                x.clear()

        for batch in batches:
            for w in split_words(batch.column(1), SPACED):
                tok, n, h = tokens_of(w, head, model.n_head)
                ids.append(batch.column(0).slice(w.first, len(n)))
                toks.append(tok)
                counts_.append(n)
                hashes.append(h)
                if sum(map(len, toks)) >= p.score_words:
                    yield from go()
        if ids:
            yield from go()

    scored = source.select("doc_id", "t").mapInArrow(
        score, "doc_id long, n_tokens long, n_known long, logs double, model double, rare array<long>, times array<int>")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("h"), F.col("r.times").alias("k"))
    more = (rare.join(counts.filter(F.col("cls") < TAIL).select("h", "c"), "h")
                .groupBy("row").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("l")))
    all_log = math.log10(vocab.tokens + vocab.types + 1)
    return (scored.join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("l", F.lit(0.0)) - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("model") + F.coalesce("l", F.lit(0.0))).alias("score")))


def in_fold(id_col: str, parts: int, value: int):
    """True for rows whose crc32 fold is ``value`` (false for null ids)."""
    return F.coalesce(fold(id_col, parts) == value, F.lit(False))
