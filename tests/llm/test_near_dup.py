import random
import re

from strata.llm.near_dup import NearDupParams, near_duplicates, prune_below
from tests.llm.cases import SF, clashing, docs, odd_rows

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    sets = {d: shingle_set(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_equals_brute_force_on_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in table.collect()], 4)
    got = result(near_duplicates(table, NearDupParams(k=4)))
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert any(not k for _, _, k in got.values())


def test_equals_brute_force_in_a_large_group(spark):
    """Hundreds of variants of one text, many just above or below the threshold."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(250):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        rows.append((d, " ".join(w)))
    want = brute(rows, 4)
    got = result(near_duplicates(docs(spark, rows), NearDupParams(k=4, chunk=32, unit=2048)))
    assert {d: v[:2] for d, v in got.items()} == want
    assert 1 < len({c for _, c in want.values()}) < 250


def test_odd_rows_and_clashing_columns(spark):
    out = near_duplicates(clashing(docs(spark, odd_rows())), NearDupParams(k=5)).collect()
    assert len(out) == len(odd_rows())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.component_id, r.kept, r.n_shingles))
    assert by[1] == [by[1][0]] * 2 and by[1][0][:2] == (1, True)
    assert by[2][0][:2] == (1, False)
    assert by[3] == [(3, True, 0)] and by[4] == [(4, True, 0)] and by[6] == [(6, True, 0)]
    assert sorted(by[None], key=str) == sorted([(1, False, by[1][0][2]), (None, True, 0)], key=str)
    assert all(r[1] for r in by[7])


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).count() == 0


def test_pruning_keeps_likely_links():
    cut = prune_below(240, 24, 4, 5, 1e-4)
    assert len(cut) == 10 and all(a <= b for a, b in zip(cut, cut[1:]))
    assert 160 < cut[-1] < 180  # agreements that a pair at 0.8 misses once in 10 000
