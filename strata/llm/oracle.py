"""DuckDB SQL for the registered llm queries that SQL can express.

op1, op2, op3, op6, op7, op8 depend on a search, a seeded choice, corpus-fitted spans or a
trained model; op10 on a tokenizer library, op11 on eigenvectors, op13 on a piece model: these are tested by
brute force or against the library instead. op5
compares sets pair by pair, which is no query for whole tables; it is tested against brute
force on fixtures too.
"""

SQL = {
    "op4_positional_decontamination": r"""
        with recursive doc_words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        item_words as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        item_windows as (
            select distinct item_id, least(len(w), 10) as width, list_slice(w, s, s + least(len(w), 10) - 1) as run
            from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from item_words where len(w) > 0)),
        widths as (select distinct width from item_windows),
        doc_windows as (
            select doc_id, width, s, list_slice(w, s, s + width - 1) as run
            from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) as s
                  from doc_words, widths where len(w) >= width)),
        hits as (
            select d.doc_id, d.s, d.width, i.item_id from doc_windows d join item_windows i
            on d.width = i.width and d.run = i.run),
        covered as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(s, s + width)) as p from hits) group by doc_id),
        named as (
            select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
            from (select distinct doc_id, cast(item_id as varchar) as id from hits) group by doc_id)
        select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit,
               cast(coalesce(n.n_items, 0) as bigint) as n_items, sha256(coalesce(n.ids, '')) as items_sha256,
               coalesce(c.n_hit, 0) > 0 as contaminated
        from doc_words d left join covered c on d.doc_id = c.doc_id left join named n on d.doc_id = n.doc_id""",
    "op9_revisit_resolution": r"""
        with base as (
            select page_id as i, regexp_replace(url, '(://[^/?#]*/[^/?#]*).*$', '\1') as section,
                   1600000000 + (page_id * 7919) % 1000003 as t0, strlen(html) as size,
                   '"' || substr(md5(html), 1, 12) || '"' as tag, 'sha1:' || upper(sha1(html)) as sha
            from pages),
        base2 as (
            select *, case when i % 5 <> 0 then tag end as etag, case when i % 7 <> 0 then 't' || t0 end as lm,
                   case when i % 11 = 0 then sha end as digest from base),
        visits as (select i, section, t0 + 1 + (i * 104729) % 50000 as ts, t0, etag, lm, digest from base2),
        ranked as (
            select v.i, v.section, v.ts, v.t0, v.etag, v.lm, v.digest, r.i as ri, r.t0 as rt0, r.etag as retag,
                   r.lm as rlm, r.digest as rdigest, r.size,
                   row_number() over (partition by v.i order by r.t0 desc, 'r' || r.i desc) as k
            from visits v left join base2 r on r.section = v.section and r.t0 < v.ts),
        judged as (
            select *, case when ri is null then 'missing'
                when etag <> retag or lm <> rlm or digest <> rdigest then 'mismatch'
                when etag = retag or lm = rlm or digest = rdigest then 'resolved' else 'unverified' end as outcome
            from ranked where k = 1)
        select 'v' || i as record_id, section as url_key, ts, 'r' || ri as resolved_from, outcome,
               case when outcome in ('resolved', 'unverified') then
                   'Cache-Control=no-cache;Content-Length=' || size || ';Content-Type=text/html;X-Page=' || ri
                   || ';date=' || (t0 + 1) end as headers
        from judged""",
    "op12_conversation_trie": r"""
        WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce("text", '') AS x FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST, r, x) AS p FROM t GROUP BY c),
        -- unsigned crc32 of the decimal id: one step a bit
        crc AS (SELECT c, p, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
            lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
              lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h FROM own),
        conv AS (SELECT m.c, list_concat(coalesce(l.p, [])[1:m.h], m.p[m.h + 1:]) AS p FROM crc m LEFT JOIN own l ON l.c = m.c - m.c % 100),
        step AS (SELECT c, unnest(range(len(p) + 1)) AS d, p FROM conv),
        node AS (SELECT d, p[1:d] AS k, min(c) AS id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(p) = d) AS ends
          FROM step GROUP BY 1, 2),
        up AS (SELECT m.d, m.k, m.id, m.n, m.ends, u.id AS parent FROM node m LEFT JOIN node u ON u.d = m.d - 1 AND u.k = m.k[1:m.d - 1]),
        kids AS (SELECT parent AS id, d - 1 AS d, count(*) AS kids FROM up WHERE d > 0 GROUP BY 1, 2),
        full_node AS (SELECT u.*, coalesce(q.kids, 0) AS kids, CASE WHEN u.d = 0 THEN 0 ELSE (u.n - 1) * length(u.k[u.d].x) END AS own
          FROM up u LEFT JOIN kids q ON q.id = u.id AND q.d = u.d),
        below AS (SELECT z.k[1:z.a] AS k, z.a AS d, sum(own) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
          FROM (SELECT k, own, kids, unnest(range(d + 1)) AS a FROM full_node) z GROUP BY 1, 2)
        SELECT f.id AS conv_id, f.d::BIGINT AS depth, f.parent AS parent_conv_id, f.n::BIGINT AS n_convs, f.kids::BIGINT AS n_children,
          b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
        FROM full_node f JOIN below b ON b.d = f.d AND b.k = f.k""",
}
