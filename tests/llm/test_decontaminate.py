import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.decontaminate import build_index, contamination, phrase_matches, proximity_matches, windows_of
from tests.llm.cases import SF, clashing, docs, odd_rows

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(rows, items, width):
    runs = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            runs.setdefault(tuple(w[s:s + width]), set()).add(str(i))
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(r) for r in runs}:
            for s in range(len(w) - n + 1):
                own = runs.get(tuple(w[s:s + n]))
                if own:
                    hit.update(range(s, s + n))
                    found |= own
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=str)


def item_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_brute_force_on_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()], 10)
    assert result(contamination(d, b)) == want
    assert any(r[2] for r in want)


def test_equals_brute_force_with_few_words_and_small_segments(spark):
    rng = random.Random(1)
    rows = [(d, " ".join(rng.choice("a b c d E.").strip() for _ in range(rng.randint(0, 40)))) for d in range(60)]
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 6)))) for i in range(12)] + [(1, "a b a")]
    want = brute(rows, items, 3)
    assert result(contamination(docs(spark, rows), item_table(spark, items), width=3)) == want
    index = build_index(docs(spark, rows).coalesce(1), segment_words=4)
    assert index.docs.select("segment").distinct().count() > 1
    got = phrase_matches(index, windows_of(item_table(spark, items), 3))
    hits = {(r.doc_id, r.item_id) for r in got.collect()}
    assert hits == {(d, i) for d, _, _, own in want for i in own}


def test_proximity_in_any_order(spark):
    rows = [(1, "red x x green x blue"), (2, "blue green red"), (3, "red x x x x x x green blue"), (4, "red green")]
    index = build_index(docs(spark, rows))
    w = windows_of(item_table(spark, [(9, "green blue red")]), 3)
    assert {r.doc_id for r in proximity_matches(index, w, 6).collect()} == {1, 2}
    assert {r.doc_id for r in proximity_matches(index, w, 3).collect()} == {2}
    assert {r.doc_id for r in phrase_matches(index, w).collect()} == set()
    with pytest.raises(ValueError):
        proximity_matches(index, w, 65)


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    items = item_table(spark, [(1, " ".join("the quick brown fox jumps over a lazy dog while".split())), (2, None), (3, ""),
                               (None, "word"), (4, "word")])
    rows = odd_rows()
    out = contamination(clashing(docs(spark, rows)), items.withColumn("segment", F.lit("x")))
    want = brute([(r[0], r[1]) for r in rows], [(1, "the quick brown fox jumps over a lazy dog while"), (4, "word")], 10)
    assert result(out) == want
    assert result(contamination(docs(spark, rows), items.limit(0))) == brute([(r[0], r[1]) for r in rows], [], 10)
    assert contamination(docs(spark, []), items).count() == 0
