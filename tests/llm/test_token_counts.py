import random

import pytest

import strata.llm.token_counts as counts_module
from strata.llm.queries import tokenizer_path
from strata.llm.token_counts import _tokenizer, frequent_runs, token_counts
from tests.llm.cases import SF, clashing, docs, odd_rows

PATH = tokenizer_path("word_bpe_49k.json")


def want(rows):
    tok = _tokenizer(PATH)
    return sorted((str(d), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False))) for d, t in rows)


def got(df):
    out = df.collect()
    assert all(r.over_limit == (r.n_tokens > 2048) for r in out)
    return sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out)


def test_counts_equal_the_library(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(token_counts(d, PATH)) == want([(r.doc_id, r.text) for r in d.collect()])


@pytest.mark.parametrize("frequent, cache", [(0, 1), (3, 4), (100, 1 << 10)])
def test_odd_texts_whatever_the_tiers_hold(spark, frequent, cache):
    rng = random.Random(8)
    bits = ["a", "The", "'s", "'ll", "1", "23", ".", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", " ", "é", "é",
            "́", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|", "ß", "中", "😀", "\x00"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(200)]
    assert got(token_counts(docs(spark, rows), PATH, frequent=frequent, cache=cache)) == want(rows)


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    assert got(token_counts(clashing(docs(spark, rows)), PATH)) == want([(r[0], r[1]) for r in rows])
    assert token_counts(docs(spark, []), PATH).count() == 0


def test_frequent_runs_are_bounded(spark):
    df = docs(spark, [(1, "a a a b b " + "x" * 100 + " " + "x" * 100)])
    assert frequent_runs(df, "text", 2, 64) == [b"a", b"b"]


def test_plain_runs_go_to_the_library_many_at_once(monkeypatch):
    rng = random.Random(3)
    bits = ["a", "The", "'s", "'", "9", "42", ".", "!?", "<|", "|>", "ing", "\x00", "\x1c", "x" * 30]
    runs = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 8))) for _ in range(640)]
    odd = ["é", "İ'sΣ", "́", "क़", "a<|endoftext|>b", "<|startoftext|>", "\x85", " ", "中ß😀"]
    library, calls = _tokenizer(PATH), []

    class Counted:
        def __getattr__(self, name):
            got = getattr(library, name)
            return (lambda *a, **k: calls.append(name) or got(*a, **k)) if name.startswith("encode") else got

    monkeypatch.setattr(counts_module, "_tokenizer", lambda path: Counted())
    lens = counts_module._encode_json(PATH, runs + odd)
    assert calls == ["encode"] * (640 // counts_module.JOINED + len(odd))
    assert lens == [len(library.encode(r, add_special_tokens=False)) for r in runs + odd]
