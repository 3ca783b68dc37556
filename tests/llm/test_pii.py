import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm._tables import key_filter, may_hold, written
from strata.llm.pii import PiiParams, _scan, base_spans, digest, disclosures, find_pii, luhn, mentions, sanitise_text, sanitised
from tests.llm.cases import clashing, docs, odd_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def by_patterns(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.", "@", "@", "1", "23", ".", ".", " ", "-", "+", "(", "é", "4532015112830366", "0"]), max_size=24))
def test_base_spans_equal_the_plain_patterns(parts):
    t = "".join(parts)
    assert base_spans(t) == by_patterns(t)


def test_hopeless_runs_take_no_time():
    assert base_spans("1" * 200_000 + " " + "a" * 200_000 + "@ " + "9" * 200_000 + ".") == []


def test_terms_that_reveal_an_entity_are_flagged(spark):
    """``zorblatt`` shows up only beside one address, ``meeting`` everywhere."""
    rows = [(i, f"intro{i} meeting with zorblatt bob@example.com meeting end{i}") for i in range(6)]
    rows += [(100 + i, f"plain meeting text number{i} goes on") for i in range(30)]
    out = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    text = rows[0][1]
    assert [text[t.start:t.end] for t in out[0].terms if t.end - t.start > 4] == ["zorblatt"]
    assert all(not out[100 + i].terms and not out[100 + i].spans for i in range(30))
    flat = digest(find_pii(docs(spark, rows))).filter("doc_id = 0").first()
    s = text.index("bob@")
    assert flat.n_email == 1 and flat.base_sha256 == hashlib.sha256(f"email:{s}:{s + 15}".encode()).hexdigest()
    assert f"email:{s}:{s + 15}" in flat.spans.split(",")
    clean = {r.doc_id: r.text for r in sanitised(docs(spark, rows)).collect()}
    assert "zorblatt" not in clean[0] and "[EMAIL]" in clean[0] and "meeting" in clean[0]
    assert all(clean[100 + i] == t for i, (_, t) in enumerate(rows[6:]))


def flagged(row, text):
    return {text[t.start:t.end] for t in row.terms}


def test_an_entity_of_one_document_takes_part(spark):
    """Addresses are rarely repeated: a word found only beside one is flagged, a usual one is not."""
    rows = [(0, "meeting with zorblatt bob@example.com meeting")]
    rows += [(i, f"plain meeting with number{i} goes on") for i in range(1, 200)]
    out = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    assert flagged(out[0], rows[0][1]) == {"zorblatt"}
    assert not any(out[i].terms for i in range(1, 200))


def test_capitals_outside_ascii_are_lowered_alike(spark):
    rows = [(i, f"Écluse{i} ÉMILIENNE {w} bob@example.com Привет") for i, w in enumerate(["Émilienne", "émilienne"] * 4)]
    rows += [(100 + i, f"plain text{i} with ÉTÉ and été") for i in range(60)]
    out = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    for i in range(8):
        assert {"ÉMILIENNE", rows[i][1].split()[2], "Привет"} <= flagged(out[i], rows[i][1])


def test_copies_of_a_text_count_once(spark):
    """Groups of copies neither hide a disclosing term nor make a usual word one."""
    rows = [(i, f"with zorblatt bob@example.com variant{i % 3} usual") for i in range(300)]
    rows += [(1000 + i, f"usual words in text{i} with rest") for i in range(700)]
    out = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    assert all("zorblatt" in flagged(out[i], t) and not {"with", "usual"} & flagged(out[i], t) for i, t in rows[:300])
    want = 1 + math.log2((3 + 3 / 703) / 4) / math.log2(703 / 3)
    text = rows[0][1]
    assert [t.disclosure for t in out[0].terms if text[t.start:t.end] == "zorblatt"] == [pytest.approx(want)]


def test_key_filter_lets_all_its_keys_through(spark):
    rng = np.random.default_rng(7)
    keys, others = (rng.integers(-2**63, 2**63 - 1, n) for n in (3000, 100_000))
    bits = key_filter(spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long"), "k")
    assert may_hold(bits, keys).all() and may_hold(bits, others).mean() < 0.001


def test_flagged_terms_are_found_anywhere(spark):
    """Far from the address, in documents without it, capitalised, after wide characters."""
    far = "usual " * 40
    rows = [(i, f"note{i} zorblatt bob@example.com {far}«é😀» (Zorblatt), {far}x@zorblatt.com ZORBLATT") for i in range(20)]
    rows += [(100, f"{far} 中 Zorblatt! goes on")]
    rows += [(200 + i, f"usual text{i} goes on") for i in range(400)]
    got = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    for i, t in rows[:21]:
        want = [m.span() for m in re.finditer("zorblatt(?!\\.com)", t, re.I)]
        assert [(x.start, x.end) for x in got[i].terms if (x.start, x.end) in want] == want and len(want) == (1 if i == 100 else 3)
        assert not any("zorblatt.com" in t[x.start:x.end] for x in got[i].terms)
    assert not any(got[200 + i].terms for i in range(400))
    clean = {r.doc_id: r.text for r in sanitised(docs(spark, rows)).collect()}
    assert len(clean) == len(rows) and not any("zorblatt" in t.lower() for t in clean.values())
    assert all(clean[i] == t for i, t in rows[21:])


def test_flagged_pairs_equal_a_plain_count(spark):
    """All counts over all words, without the passes that leave hopeless terms out."""
    p = PiiParams()
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("t"))
    texts = {r.text_key: r.t or "" for r in d.collect()}
    near, n_term = {}, Counter()
    strip = ".,;:!?\"'()[]{}<>"
    for key, t in texts.items():
        for entity, term in mentions(t, base_spans(t), p.window):
            near.setdefault((entity, term.lower()), set()).add(key)
        n_term.update({w.strip(strip) for w in re.split("[\x20\x09-\x0D]+", t.lower())} - {""})
    n_entity = {}
    for (entity, _), keys in near.items():
        n_entity.setdefault(entity, set()).update(keys)
    want = {}
    for (entity, term), keys in near.items():
        if not n_term[term]:  # the rest of a word that the entity is part of, nowhere a word
            continue
        share = len(n_entity[entity]) / len(texts)
        n = max(n_term[term], len(keys))
        one, two = ((len(keys) - k + p.prior * share) / (n - k + p.prior) for k in (0, 1))
        disclosure, elsewhere = (1 - math.log2(x) / math.log2(share) for x in (one, two))
        if disclosure >= p.generalise_at:
            want[(entity, term)] = (pytest.approx(disclosure), pytest.approx(elsewhere))
    seen = written(_scan(d, p), "test-scan")
    pairs = seen.select("text_key", F.explode("near").alias("m")).select("text_key", "m.*").distinct()
    counted = seen.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    got = {(r.entity, r.term): (r.disclosure, r.elsewhere) for r in disclosures(pairs, d, counted, p).collect()}
    assert got.keys() == want.keys() and len(want) > 50
    assert all(got[k] == want[k] for k in want)


def test_planted_terms_precision_and_recall(spark):
    """Words that give an address away are flagged in every document; words that one document
    shows beside an address are flagged there at most."""
    rows, telling, innocent = [], [], []
    for j in range(30):
        rows += [(1000 * j + i, f"note{j}x{i} with zorb{j} box{j}@mail.com today") for i in range(5)]
        rows.append((1000 * j + 5, f"other note{j}x5 of zorb{j} today"))
        telling += [(1000 * j + i, f"zorb{j}") for i in range(6)]
        rows.append((1000 * j + 10, f"meet plain{j} at once{j}@mail.com now{j}"))
        for i in range(11, 13):
            rows.append((1000 * j + i, f"text{j}x{i} on plain{j} goes on"))
            innocent.append((1000 * j + i, f"plain{j}"))
    rows += [(100_000 + i, f"with today meet at of on goes now other text nr{i}") for i in range(1500)]
    got = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    text = dict(rows)
    assert all(w in flagged(got[i], text[i]) for i, w in telling)
    assert not any(w in flagged(got[i], text[i]) for i, w in innocent)
    clean = [i for i, t in rows if i >= 100_000 or i % 1000 in (11, 12)]
    assert not any(got[i].terms for i in clean)


def test_replacements():
    p = PiiParams()
    t = "call Anna 7 or x@y.zz"
    spans = base_spans(t)
    assert sanitise_text(t, spans, [(5, 9, 0.85), (10, 11, 0.85)], p) == "call [NAME] [NUMBER] or [EMAIL]"
    assert sanitise_text(t, spans, [(5, 9, 0.99)], p) == "call  7 or [EMAIL]"
    assert sanitise_text("", [], [], p) == ""


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows() + [(9, None), (10, "+49 30 1234567 x")]
    df = clashing(docs(spark, rows))
    out = digest(find_pii(df)).collect()
    assert len(out) == len(rows) and [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in out if r.doc_id == 10] == [(0, 0, 0, 1)]
    clean = sanitised(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    got = {r.doc_id: r.text for r in clean.collect() if r.doc_id in (3, 4, 10)}
    assert got == {3: None, 4: "", 10: "[PHONE] x"}
    assert find_pii(docs(spark, [])).count() == 0 and sanitised(docs(spark, [])).count() == 0
