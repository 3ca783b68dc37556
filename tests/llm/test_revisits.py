import random

from pyspark.sql import functions as F

from strata.llm.revisits import as_of, canonical_url, captures_of_pages, resolve_revisits

SCHEMA = ("record_id string, url string, ts long, kind string, status int, etag string, last_modified string, "
          "digest string, headers array<struct<name string, value string>>")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(i, url, ts, kind="response", status=None, etag=None, lm=None, digest=None, headers=None):
    return (i, url, ts, kind, status or (200 if kind == "response" else 304), etag, lm, digest, headers)


def result(df):
    return {r.record_id: (r.resolved_from, r.outcome, r.headers and sorted((h.name, h.value) for h in r.headers)) for r in df.collect()}


def test_canonical_urls(spark):
    pairs = {"HTTP://Ex.COM:80/A?b#c": "http://ex.com/A?b", "https://ex.com:443": "https://ex.com/", " http://e.com?q ": "http://e.com/?q",
             "https://ex.com:8443/": "https://ex.com:8443/", "not a url": "not a url", "": "",
             "HTTPS://User:Pa@Ss@Ex.COM:443/X": "https://User:Pa@Ss@ex.com/X"}
    df = spark.createDataFrame([(k, v) for k, v in pairs.items()] + [(None, None)], "u string, w string")
    assert all(r.c == r.w for r in df.select(canonical_url(F.col("u")).alias("c"), "w").collect())


def test_repeated_record_ids_have_one_header_list(spark):
    rows = [row("r", "http://a/", 1, etag="x", headers=[("X", "2")]), row("r", "http://a/", 1, etag="x", headers=[("X", "1")]),
            row("v", "http://a/", 5, "revisit", etag="x", headers=[("Age", "8")]), row("v", "http://a/", 5, "revisit", etag="x", headers=[("Age", "7")])]
    for order in (rows, rows[::-1]):
        out = resolve_revisits(table(spark, order)).collect()
        assert [sorted((h.name, h.value) for h in r.headers) for r in out] == [[("Age", "7"), ("X", "1")]] * 2


def test_outcomes_and_header_merge(spark):
    h = [("Content-Type", "text/html"), ("Date", "1"), ("X", "old")]
    rows = [row("r1", "http://a/x", 10, etag='"v1"', headers=h), row("r2", "http://a/x", 20, etag='"v2"', headers=h),
            row("r3", "http://a/x", 20, etag='"v3"', status=404), row("p", "http://a/x", 25, status=206, etag='"v2"'),
            row("a", "HTTP://A:80/x#f", 30, "revisit", etag='W/"v2"', headers=[("date", "9"), ("Content-Type", "no"), ("Age", "3")]),
            row("b", "http://a/x", 15, "revisit", etag='"v2"'), row("c", "http://a/x", 10, "revisit", etag='"v1"'),
            row("d", "http://a/x", 21, "revisit"), row("e", None, 30, "revisit"), row("f", "http://a/x", None, "revisit"),
            row("g", "http://b/", 30, "revisit", etag="q"), row("h", "http://a/x", 40, "revisit", etag='"v2"', lm="z", digest="s"),
            row("z", "http://a/x", 41, "metadata")]
    got = result(resolve_revisits(table(spark, rows).withColumn("key", F.lit("x")).withColumn("match", F.lit("x"))))
    assert got["a"] == ("r2", "resolved", [("Age", "3"), ("Content-Type", "text/html"), ("X", "old"), ("date", "9")])
    assert got["b"] == ("r1", "mismatch", None)
    assert got["c"][:2] == (None, "missing")  # a response at the same time is not earlier
    assert got["d"][:2] == ("r2", "unverified")
    assert got["e"][:2] == got["f"][:2] == got["g"][:2] == (None, "missing")
    assert got["h"][:2] == ("r2", "resolved")
    assert "z" not in got and len(got) == 8


def test_as_of_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", "c"]), rng.randint(0, 300), f"i{n}", rng.random() < 0.3) for n in range(800)]
    df = spark.createDataFrame(rows, "key string, ts long, id string, full boolean")
    for parts in (1, 7):
        for r in as_of(df, parts).collect():
            best = max(((t, i) for k, t, i, f in rows if f and k == r.key and t < r.ts), default=None)
            assert (r.match and (r.match.ts, r.match.id)) == best


def test_repeated_rows_and_empty_tables(spark):
    rows = [row("r", "http://a/", 1, etag="e")] * 2 + [row("v", "http://a/", 2, "revisit", etag="e")] * 2
    out = resolve_revisits(table(spark, rows)).collect()
    assert [(r.record_id, r.outcome) for r in out] == [("v", "resolved")] * 2
    assert resolve_revisits(table(spark, [])).count() == 0


def test_captures_follow_the_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/en/1", "x"), (2, None, None), (None, "http://a.b/en/2", "y")],
                                  "page_id long, url string, html string")
    out = captures_of_pages(pages)
    assert out.count() == 6 and resolve_revisits(out).count() == 3
