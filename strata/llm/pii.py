"""Personal data in whole texts, and what gives it away.

Base: e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers are found by
their patterns, leftmost and non-overlapping per kind.

Information-theoretic step: a protected entity c (a found value) is also revealed by terms
that keep its company. Over the whole corpus, with document frequencies of the entity, of
the terms and of both together (the term within ``window`` words of the entity),

    IC(c) = -log2 p(c),    PMI(c; t) = log2 p(c, t) / (p(c) p(t)),    disclosure = PMI / IC

is the share of the entity's information that the term gives away: 1 if it occurs nowhere
else. Since PMI / IC = 1 + log2 p(c | t) / IC, the estimate that matters is p(c | t). It is
smoothed by ``prior`` documents of the term that show the entity no more often than chance,
(both + prior p(c)) / (n_term + prior), so entities of a single document take part and what
few documents show weighs less. A term's disclosure is the largest over all entities. In the
documents that show it beside the entity it is this estimate. In any other document the
estimate leaves one joint document out, (both - 1 + prior p(c)) / (n_term - 1 + prior): what a
single document shows proves nothing about others, what several show holds wherever the term
stands. Terms from ``generalise_at`` on are replaced by their category, terms from
``remove_at`` on are removed.

Counts and matches cover all words of all documents. Terms are matched by hash, after a
filter of fixed size; of the texts, only those with flagged terms are shuffled, to be cleaned.
A term that occurs in too many texts cannot reach ``generalise_at`` whatever else is known of
it. A count over a part of the texts is a lower bound of the whole count, so terms that
exceed their bound in a 64th, then in an eighth of the texts drop out before all texts are
counted; this leaves every flagged term and spares counting the common words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import key_filter, may_hold, passing_tables, prepare, written
from strata.llm._text import SPACED, Words, split_words, text_bytes

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The lookbehinds and possessive repeats only spare hopeless retries inside one run.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS = re.compile(r"[0-9]")


@dataclass(frozen=True)
class PiiParams:
    """See the module text. All probabilities are shares of the table's distinct texts."""

    window: int = 8
    prior: float = 1.0
    generalise_at: float = 0.8
    remove_at: float = 0.95


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, seen from each ``@``: the
    local part is the run of its characters to the left, back to the previous match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ip_ok(s: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in s.split("."))


def _card_ok(s: str) -> bool:
    d = s.replace(" ", "").replace("-", "")
    return 14 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of all base findings, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _ip_ok(m.group())]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and _card_ok(m.group())]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 10 <= len(_DIGITS.findall(m.group())) <= 15]
    return sorted(out)


def entity_value(kind: int, raw: str) -> str:
    """One form per protected value: lower-case address, bare digits of numbers."""
    return raw.lower() if kind < 2 else "".join(_DIGITS.findall(raw))


def _term(word: str) -> tuple[str, int, int]:
    """A word without the punctuation around it, as written, and where it lies in the word.
    Terms are lowered per batch by ``utf8_lower``, everywhere: letter by letter, so places
    in the text stay."""
    left = len(word) - len(word.lstrip(".,;:!?\"'()[]{}<>"))
    core = word.strip(".,;:!?\"'()[]{}<>")
    return core, left, left + len(core)


def _outside(spans: list[tuple[int, int, int]]):
    """Whether ``(start, end)`` touches none of the base spans."""
    ends: list[int] = []  # running maximum: spans of different kinds may overlap
    for _, _, e in spans:
        ends.append(max(e, ends[-1]) if ends else e)
    starts = [s for s, _, _ in spans]

    def free(s: int, e: int) -> bool:
        i = bisect_left(starts, e)  # spans that start before e
        return i == 0 or ends[i - 1] <= s

    return free


def mentions(text: str, spans: list[tuple[int, int, int]], window: int):
    """``(entity, term)`` for the words within ``window`` words of each base span, words
    that belong to a base span left out."""
    free = _outside(spans)
    for start, kind, end in spans:
        entity = f"{KINDS[kind]}:{entity_value(kind, text[start:end])}"
        # Words to the left are read from a stretch that grows until it holds enough.
        size = 16 * window
        while True:
            lo = max(0, start - size)
            left = [m for m in _WORD.finditer(text, lo, start) if m.start() > lo or lo == 0]
            if len(left) >= window or lo == 0:
                break
            size *= 2
        right = []
        for m in _WORD.finditer(text, end):
            right.append(m)
            if len(right) == window:
                break
        for m in left[-window:] + right:
            term, a, b = _term(m.group())
            if term and free(m.start() + a, m.start() + b):
                yield entity, term


def _scan(docs: DataFrame, p: PiiParams) -> DataFrame:
    """Per row of ``(doc_id, text_key, t)``: key of the text and words near base spans."""
    prepare(docs.sparkSession)
    pair = pa.struct([("entity", pa.string()), ("term", pa.string())])

    def scan(batches):
        for batch in batches:
            near = []
            for t in batch.column(2):
                text = t.as_py() or ""
                own = base_spans(text)
                near.append(list(mentions(text, own, p.window)))
            terms = iter(pc.utf8_lower(pa.array([w for own in near for _, w in own], pa.string())).to_pylist())
            near = [[{"entity": c, "term": next(terms)} for c, _ in own] for own in near]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(near, pa.list_(pair))], ["text_key", "near"])

    return docs.mapInArrow(scan, "text_key long, near array<struct<entity string, term string>>")


def _places(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Per row of ``(doc_id, text_key, t)``: base spans, and the places and hashes of all its
    terms that pass the filter ``wanted`` and are outside the base spans."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(wanted)
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("h", pa.int64())])

    def scan(batches):
        for batch in batches:
            own = [base_spans(t.as_py() or "") for t in batch.column(2)]
            found: list[list[dict]] = [[] for _ in own]
            low = pc.utf8_lower(batch.column(2))
            _, offs = text_bytes(low)
            for w in split_words(low, SPACED):
                _trim(w)
                h = w.hashes()
                at = np.flatnonzero(may_hold(shared.value, h) & (w.starts < w.ends))
                if not len(at):
                    continue
                doc = np.repeat(np.arange(w.first, w.first + len(w.counts)), w.counts)[at]
                # places in characters: lowering and the byte table keep their number
                before = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
                first = before[offs[doc] - offs[w.first]]
                for d, s, e, x in zip(doc.tolist(), (before[w.starts[at]] - first).tolist(),
                                      (before[w.ends[at]] - first).tolist(), h[at].view(np.int64).tolist()):
                    found[d].append({"start": s, "end": e, "h": x})
            for spans, places in zip(own, found):
                if spans and places:
                    free = _outside(spans)
                    places[:] = [x for x in places if free(x["start"], x["end"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans in own], pa.list_(span)),
                 pa.array(found, pa.list_(place))], ["doc_id", "text_key", "spans", "places"])

    return docs.mapInArrow(scan, "doc_id long, text_key long, spans array<struct<start long, kind int, end long>>, "
                                 "places array<struct<start long, end long, h long>>")


_TRIM = np.zeros(256, bool)
_TRIM[list(b".,;:!?\"'()[]{}<>")] = True


def _trim(w: Words) -> None:
    """Words become terms: the punctuation at both ends goes (all of it may go)."""
    s, e = w.starts.copy(), w.ends.copy()
    todo = np.arange(len(s))
    while len(todo):
        todo = todo[(s[todo] < e[todo]) & _TRIM[w.data[np.minimum(s[todo], len(w.data) - 1)]]]
        s[todo] += 1
    todo = np.arange(len(s))
    while len(todo):
        todo = todo[(s[todo] < e[todo]) & _TRIM[w.data[e[todo] - 1]]]
        e[todo] -= 1
    w.starts, w.ends = s, e


def _term_documents(docs: DataFrame, repeated: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """``(h, text_key, df)`` of ``(text_key, t)``: documents that hold each term, as partial
    counts per task; the terms of texts that may occur again, each under its text's key.

    The terms of a document are its words without the punctuation around them; they are
    matched by hash, and only those that pass the filter ``wanted`` are counted.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((repeated, wanted))

    def rows(h, key, n):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(key, pa.int64()), pa.array(n, pa.int64())],
                                          ["h", "text_key", "df"])

    def count(batches):
        repeated, wanted = shared.value
        held: list[np.ndarray] = []
        sums: list[np.ndarray] = []

        def merge():
            h, n = np.concatenate(held), np.concatenate(sums)
            u, inv = np.unique(h, return_inverse=True)
            return u, np.bincount(inv, weights=n).astype(np.int64)

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for w in split_words(pc.utf8_lower(batch.column(1)), SPACED):
                _trim(w)
                h = w.hashes()
                doc = np.repeat(np.arange(w.first, w.first + len(w.counts)), w.counts)
                own = may_hold(wanted, h)
                h, doc = h[own], doc[own]
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, key = h[new], keys[doc[new]]
                again = may_hold(repeated, key)
                if again.any():
                    yield rows(h[again], key[again], np.ones(again.sum(), np.int64))
                u, n = np.unique(h[~again], return_counts=True)
                held.append(u)
                sums.append(n)
            if sum(map(len, held)) > 1 << 21:
                u, n = merge()
                if len(u) > 1 << 20:  # hand on what is summed so far
                    yield rows(u, [None] * len(u), n)
                    held, sums = [], []
                else:
                    held, sums = [u], [n]
        if held:
            u, n = merge()
            yield rows(u, [None] * len(u), n)

    return docs.select("text_key", "t").mapInArrow(count, "h long, text_key long, df long")


def _term_hash(terms: DataFrame) -> DataFrame:
    """``(term)`` -> ``(term, h)`` with the hash that ``_term_documents`` counts by."""

    def hashes(batches):
        for batch in batches:
            hs = []
            for w in split_words(batch.column(0), SPACED):
                h, offs = w.hashes(), w.offsets()
                hs += [int(h[offs[i]].view(np.int64)) if w.counts[i] == 1 else None for i in range(len(w.counts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hs, pa.int64())], ["term", "h"])

    return terms.mapInArrow(hashes, "term string, h long")


#: Shares (one in so many) of the texts that are counted before all of them.
PARTS = (64, 8)


def _term_counts(docs: DataFrame, texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n_term)``: distinct texts that hold each term, of ``(term, h, bound)``; terms
    that a part of the texts shows to be above their bound are left out."""
    repeated = key_filter(texts.filter("copies > 1"), "text_key")
    # copies of a text count once; null keys are sums over texts that occur once
    once = F.when(F.col("text_key").isNull(), F.sum("df")).otherwise(F.lit(1))

    def counted(some: DataFrame, terms: DataFrame) -> DataFrame:
        rows = _term_documents(some, repeated, key_filter(terms, "h"))
        return (rows.join(terms, "h").groupBy("term", "h", "bound", "text_key").agg(once.alias("df"))
                    .groupBy("term", "h", "bound").agg(F.sum("df").alias("n_term")))

    for share in PARTS:
        over = counted(docs.filter(F.pmod("text_key", F.lit(share)) == 0), terms).filter("n_term > bound")
        terms = written(terms.join(over.select("term"), "term", "left_anti"), "pii-terms")
    return counted(docs, terms).select("term", "n_term")


def disclosures(near: DataFrame, docs: DataFrame, texts: DataFrame, p: PiiParams) -> DataFrame:
    """``(entity, term, h, disclosure, elsewhere)`` of the pairs that reach ``generalise_at``:
    the estimate for documents that show the pair, and that for all others.

    ``near``: ``(text_key, entity, term)``; ``docs``: ``(text_key, t)``; ``texts``:
    ``(text_key, copies)``. The entity's document count comes from all its mentions, the
    term's from all documents; all four counts are of distinct texts.
    """
    n_docs = texts.count()
    together = near.groupBy("entity", "term").agg(F.countDistinct("text_key").alias("both"))
    entities = near.groupBy("entity").agg(F.countDistinct("text_key").alias("n_entity"))
    p_entity = F.col("n_entity") / F.lit(float(max(n_docs, 1)))
    # (both + prior p) / (n + prior) >= p ** (1 - generalise_at), solved for n; a hair is left for rounding
    most = (F.col("both") + p.prior * p_entity) / F.pow(p_entity, F.lit(1 - p.generalise_at)) - p.prior
    pairs = written(together.join(entities, "entity").withColumn("most", most * (1 + 1e-9) + 1e-9)
                    .filter((p_entity < 1) & (F.col("both") <= F.col("most"))), "pii-pairs")
    hashed = _term_hash(pairs.select("term").distinct())
    terms = written(hashed.join(pairs.groupBy("term").agg(F.max("most").alias("bound")), "term"), "pii-terms")
    df = _term_counts(docs, texts, terms)
    ic = -F.log2(p_entity)

    def share(less: int):
        given = (F.col("both") - less + p.prior * p_entity) / (F.greatest("n_term", "both") - less + p.prior)
        return F.when(ic > 0, 1 + F.log2(given) / ic).otherwise(F.lit(0.0))

    return (pairs.join(df, "term").join(terms.select("term", "h"), "term")
                 .withColumn("disclosure", share(0)).withColumn("elsewhere", share(1))
                 .filter(F.col("disclosure") >= p.generalise_at).select("entity", "term", "h", "disclosure", "elsewhere"))


_TERMS = "array<struct<start long, end long, disclosure double>>"


def find_pii(docs: DataFrame, p: PiiParams = PiiParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, text_key, spans, terms``.

    ``spans``: base findings ``(start, kind, end)``; ``terms``: ``(start, end, disclosure)``
    of all words that give some entity of the table away, in order. ``text_key`` is a hash of the text.
    Null and empty texts have neither. Repeated rows are each reported, but copies of one
    text count as one document. An empty table gives no rows. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                         F.col(text_col).alias("t"))
    seen = written(_scan(source, p), "pii-scan")
    texts = written(seen.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies")), "pii-texts")
    near = seen.select("text_key", F.explode("near").alias("m")).select("text_key", "m.*").distinct()
    pairs = written(disclosures(near, source, texts, p), "pii-flagged")
    # what the texts that show a pair say of it, and what holds anywhere
    here = written(near.join(pairs, ["entity", "term"]).groupBy("text_key", "h").agg(F.max("disclosure").alias("here")), "pii-here")
    anywhere = pairs.groupBy("h").agg(F.max("elsewhere").alias("anywhere")).filter(F.col("anywhere") >= p.generalise_at)
    rows = written(_places(source, key_filter(pairs, "h")).withColumn("row", F.monotonically_increasing_id()), "pii-places")
    hits = rows.select("row", "text_key", F.explode("places").alias("m")).select("row", "text_key", "m.*")
    hits = hits.join(anywhere, "h", "left").join(here, ["text_key", "h"], "left")
    hits = (hits.withColumn("disclosure", F.greatest("anywhere", "here")).filter("disclosure is not null")
                .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms")))
    return (rows.select("row", "doc_id", "text_key", "spans").join(hits, "row", "left")
                .withColumn("terms", F.coalesce("terms", F.array().cast(_TERMS)))
                .drop("row"))


def _count(kind: int) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans and all spans as text."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("spans", lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"]))
    every = F.array_sort(F.concat(
        F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"])),
        F.transform("terms", lambda s: F.struct(s["start"], F.lit(len(KINDS)).alias("kind"), s["end"]))))
    named = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return found.select(
        "doc_id",
        *[_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(every, lambda s: F.concat_ws(":", named[s["kind"]], s["start"], s["end"]))).alias("spans"))


def replacement(kind: int, word: str, disclosure: float, p: PiiParams) -> str:
    """What stands for a span: the kind of a base value, the category of a term that is
    generalised, nothing for one that is removed."""
    if kind < len(KINDS):
        return f"[{KINDS[kind].upper()}]"
    if disclosure >= p.remove_at:
        return ""
    return "[NUMBER]" if _DIGITS.search(word) else "[NAME]" if word[:1].isupper() else "[TERM]"


def sanitise_text(text: str, spans, terms, p: PiiParams) -> str:
    """``text`` with all spans replaced; overlapping spans are replaced as one."""
    out, done = [], 0
    every = sorted([(s, e, k, 0.0) for s, k, e in spans] + [(s, e, len(KINDS), d) for s, e, d in terms])
    for s, e, k, d in every:
        if s < done:
            if e > done:  # the rest of a span that overlaps the one before goes with it
                done = e
            continue
        out += [text[done:s], replacement(k, text[s:e], d, p)]
        done = e
    return "".join([*out, text[done:]])


def sanitised(docs: DataFrame, p: PiiParams = PiiParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text_col``.

    All columns and rows stay; null texts stay null. Flagged terms are joined back to the
    texts that have some, which a filter of fixed size picks; all other texts stay where they
    are. Base spans are found again in place.
    """
    spark = docs.sparkSession
    prepare(spark)
    with passing_tables(spark):
        found = find_pii(docs, p, id_col, text_col).filter(F.size("terms") > 0)
        terms = written(found.select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_k"), F.col("terms").alias("_terms"))
                        .dropDuplicates(["_i", "_k"]), "pii-terms", outlives=True)
    shared = spark.sparkContext.broadcast(key_filter(terms, "_k"))
    names = docs.columns
    rows = docs.withColumn("_rk", F.xxhash64(F.col(text_col)))

    def split(held):
        def pick(batches):
            for batch in batches:
                own = may_hold(shared.value, batch.column("_rk").to_numpy(zero_copy_only=False).astype(np.int64))
                yield batch.filter(pa.array(own if held else ~own))
        return pick

    def clean(batches):
        for batch in batches:
            out = []
            for t, terms in zip(batch.column(text_col).to_pylist(), batch.column("_terms").to_pylist()):
                if t:
                    own = base_spans(t)
                    near = [(x["start"], x["end"], x["disclosure"]) for x in terms or ()]
                    t = sanitise_text(t, own, near, p) if own or near else t
                out.append(t)
            cols = [pa.array(out, pa.string()) if c == text_col else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    some = rows.mapInArrow(split(True), rows.schema)
    some = some.join(terms, some[id_col].cast("long").eqNullSafe(F.col("_i")) & (F.col("_rk") == F.col("_k")), "left")
    rest = rows.mapInArrow(split(False), rows.schema).withColumn("_terms", F.lit(None).cast(_TERMS))
    both = [x.select(*[F.col(c) for c in names], "_terms").mapInArrow(clean, docs.schema) for x in (some, rest)]
    return both[0].unionByName(both[1])
