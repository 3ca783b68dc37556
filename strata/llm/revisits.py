"""Resolution of not-modified revisits in a web archive.

A revisit record (a 304 answer) carries no body. It is resolved to the latest full
response with the same canonical URL captured before it, if the validators that both
records carry agree; the response's headers are then updated by those headers of the
revisit that may update a stored response.

The as-of join needs no group of one URL in one place: records are range-partitioned by
(URL, time), so a URL with a third of all captures spreads over many partitions. Inside a
partition a running maximum finds the latest earlier response; what came before the
partition is one carried response per (URL, partition). Only narrow columns take part;
headers are joined to the few columns of the matches at the end, and bodies never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm._tables import shuffle_partitions, written

#: Headers of a 304 answer that do not update the stored response (they
#: describe a connection or the body that the answer does not have).
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-location", "content-md5", "content-range",
    "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "set-cookie",
    "te", "trailer", "transfer-encoding", "upgrade",
)

HEADERS = "array<struct<name string, value string>>"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case (user information as it is), no fragment, no default
    port, a path at least ``/``."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)(.*)$"
    scheme = F.lower(F.regexp_extract(u, parts, 1))
    authority = F.regexp_extract(u, parts, 2)
    host = F.concat(F.regexp_extract(authority, "^(.*@)?", 0), F.lower(F.regexp_extract(authority, "[^@]*$", 0)))
    rest = F.regexp_extract(u, parts, 3)
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(u.rlike(parts), F.concat(scheme, F.lit("://"), host, path)).otherwise(u)


def _strong(etag: Column) -> Column:
    """An entity tag without its weakness mark (a 304 is validated by weak comparison)."""
    return F.regexp_replace(F.trim(etag), "^[Ww]/", "")


def verdict(mine: dict[str, Column], theirs: dict[str, Column]) -> Column:
    """``mismatch`` if a validator that both carry differs, ``resolved`` if one agrees and
    none differs, ``unverified`` if they share none."""
    same = [(_strong(mine["etag"]), _strong(theirs["etag"])),
            (F.trim(mine["last_modified"]), F.trim(theirs["last_modified"])),
            (F.lower(F.trim(mine["digest"])), F.lower(F.trim(theirs["digest"])))]
    differs = F.lit(False)
    agrees = F.lit(False)
    for a, b in same:
        both = a.isNotNull() & b.isNotNull()
        differs = differs | (both & F.coalesce(a != b, F.lit(False)))
        agrees = agrees | (both & F.coalesce(a == b, F.lit(False)))
    return F.when(differs, "mismatch").when(agrees, "resolved").otherwise("unverified")


def merged_headers(full: Column, answer: Column) -> Column:
    """The response's headers, those that the answer may update replaced by its own."""
    empty = F.array().cast(HEADERS)
    full = F.filter(F.coalesce(full, empty), lambda h: h.isNotNull())
    fresh = F.filter(F.coalesce(answer, empty), lambda h: h.isNotNull() & h["name"].isNotNull()
                     & ~F.lower(h["name"]).isin(*NOT_UPDATED))
    names = F.transform(fresh, lambda h: F.lower(h["name"]))
    kept = F.filter(full, lambda h: ~F.coalesce(F.array_contains(names, F.lower(h["name"])), F.lit(False)))
    return F.concat(kept, fresh)


def as_of(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(key, ts, id, full, ...)`` plus ``match``: the struct ``(ts, id, ...)`` of the
    latest row with ``full`` of the same key and an earlier ``ts`` (ties: the largest id)."""
    extra = [c for c in records.columns if c not in ("key", "ts", "full")]
    n = partitions or shuffle_partitions(records.sparkSession)
    rows = written(records.repartitionByRange(n, "key", "ts").withColumn("_part", F.spark_partition_id()), "as-of")
    mark = F.when(F.col("full"), F.struct("ts", *extra))
    earlier = Window.partitionBy("key", "_part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.max(mark).over(earlier))
    per = rows.groupBy("key", "_part").agg(F.max(mark).alias("_max"))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(F.col("key").alias("_k"), F.col("_part").alias("_p"), F.max("_max").over(before).alias("_carry"))
    carry = carry.filter(F.col("_carry").isNotNull())
    return (local.join(carry, (F.col("key") == F.col("_k")) & (F.col("_part") == F.col("_p")), "left")
                 .withColumn("match", F.coalesce("_local", "_carry")).drop("_part", "_local", "_carry", "_k", "_p"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record: ``record_id, url_key, ts, resolved_from, outcome, headers``.

    ``records``: ``record_id string, url string, ts long, kind string`` (``response`` or
    ``revisit``; others are ignored), ``status int, etag string, last_modified string,
    digest string, headers array<struct<name, value>>``; more columns are not read. A full
    response is a ``response`` with status 200.

    ``outcome``: ``resolved``, ``unverified`` (no validator in common), ``mismatch`` (the
    latest earlier response is another version; it is named, its headers are not taken)
    or ``missing`` (no earlier response, also for null URLs or times). ``headers`` are the
    merged ones of resolved and unverified records, else null. A response at the same
    time is not earlier; of several at one time the largest record id counts. Repeated
    revisit rows are each resolved, repeated response rows count once; of several header
    lists under one record id the smallest counts.
    """
    known = (records.filter(F.col("kind").isin("response", "revisit"))
                    .withColumn("full", F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))))
    narrow = known.filter(F.col("full") | (F.col("kind") == "revisit")).select(
        canonical_url(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"), F.col("record_id").alias("id"),
        "etag", "last_modified", "digest", "full")
    placed = narrow.filter(F.col("key").isNotNull() & F.col("ts").isNotNull())
    nowhere = narrow.filter(F.col("key").isNull() | F.col("ts").isNull())
    found = as_of(placed).filter(~F.col("full"))
    validators = ("etag", "last_modified", "digest")
    outcome = F.when(F.col("match").isNull(), "missing").otherwise(
        verdict({c: F.col(c) for c in validators}, {c: F.col(f"match.{c}") for c in validators}))
    decided = found.select("id", "key", "ts", F.col("match.id").alias("resolved_from"), outcome.alias("outcome"))
    decided = decided.unionByName(nowhere.filter(~F.col("full")).select(
        "id", "key", "ts", F.lit(None).cast("string").alias("resolved_from"), F.lit("missing").alias("outcome")))
    # Headers: those of revisits by their own id, those of responses by the matched id.
    heads = known.select("record_id", "kind", "full", F.col("headers").cast(HEADERS).alias("headers"))
    mine = heads.filter(F.col("kind") == "revisit").groupBy(F.col("record_id").alias("id")).agg(F.min("headers").alias("_mine"))
    theirs = heads.filter("full").groupBy(F.col("record_id").alias("resolved_from")).agg(F.min("headers").alias("_theirs"))
    taken = F.col("outcome").isin("resolved", "unverified")
    return (decided.join(mine, "id", "left").join(theirs, "resolved_from", "left")
                   .select(F.col("id").alias("record_id"), F.col("key").alias("url_key"), "ts", "resolved_from", "outcome",
                           F.when(taken, merged_headers(F.col("_theirs"), F.col("_mine"))).alias("headers")))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records derived from a table of pages ``(page_id, url, html)``.

    Every page is a full response and a later 304 revisit of its section (the URL without
    its last part), so sections have many versions; the spelling of the URL, the validators
    and the headers vary with the id.
    """
    i = F.col("page_id")
    section = F.regexp_replace("url", "(://[^/?#]*/[^/?#]*).*$", "$1")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 12), F.lit('"'))
    at = F.lit(1_600_000_000) + (i * 7919) % 1_000_003
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    base = pages.select(
        i, section.alias("section"), at.alias("at"),
        F.when(i % 5 != 0, tag).alias("etag"), F.when(i % 7 != 0, F.concat(F.lit("t"), at)).alias("last_modified"),
        F.when(i % 11 == 0, F.concat(F.lit("sha1:"), F.upper(F.sha1(F.coalesce("html", F.lit("")).cast("binary"))))).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    response = F.struct(
        F.concat(F.lit("r"), i).alias("record_id"), F.col("section").alias("url"), F.col("at").alias("ts"),
        F.lit("response").alias("kind"), F.lit(200).alias("status"), F.col("etag"),
        F.array(pair("Content-Type", F.lit("text/html")), pair("Content-Length", F.col("size")),
                pair("Date", F.col("at")), pair("X-Page", i)).alias("headers"))
    revisit = F.struct(
        F.concat(F.lit("v"), i).alias("record_id"),
        F.when(i % 3 == 0, F.concat(F.regexp_replace("section", "^http", "HTTP"), F.lit("#top"))).otherwise(F.col("section")).alias("url"),
        (F.col("at") + 1 + (i * 104729) % 50_000).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.when(i % 2 == 0, F.concat(F.lit("W/"), F.col("etag"))).otherwise(F.col("etag")).alias("etag"),
        F.array(pair("date", F.col("at") + 1), pair("Content-Length", F.lit(0)), pair("Cache-Control", F.lit("no-cache"))).alias("headers"))
    return (base.select("last_modified", "digest", F.explode(F.array(response, revisit)).alias("r"))
                .select("r.record_id", "r.url", "r.ts", "r.kind", "r.status", "r.etag", "last_modified", "digest", "r.headers"))
