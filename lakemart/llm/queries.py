"""Registered queries of the operators, with SQL where DuckDB can express them over the whole tables."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from pyspark.sql import functions as F

from lakemart.llm import common as C
from lakemart.llm import (conversation_repair, decontaminate, html_text, jaccard_join, packing, perplexity, quality_rules, shard_ring,
                          spelling, substring_dedup, token_store, url_filter, warc)

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLE: dict[str, str] = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op10_decontaminate(spark, sf_dir):
    return decontaminate.contamination(C.read_table(spark, sf_dir, "documents"), C.read_table(spark, sf_dir, "benchmark"))


ORACLE["op10_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, s, x.n, x.item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS words
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, sizes WHERE len(w) >= n)) d
  JOIN win x ON x.words = d.words AND x.n = d.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@_query
def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup(C.read_table(spark, sf_dir, "documents")).drop("kept")


ORACLE["op5_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d)),
lo AS (SELECT x, min(doc_id) AS lo FROM win GROUP BY x),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN lo USING (x) WHERE lo < doc_id),
gl AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1),
kept AS (SELECT doc_id, string_agg(y, ' ' ORDER BY p) AS t
         FROM (SELECT doc_id, unnest(w) AS y, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p)
         GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gl.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gl USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query
def op9_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(C.read_table(spark, sf_dir, "documents"), path))


@_query
def op1_token_store(spark, sf_dir):
    folder = C.scratch_path(spark, "token-store")
    manifest, freq = token_store.write_store(C.read_table(spark, sf_dir, "documents"), folder,
                                             public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_store(spark, folder, manifest, freq)


@_query
def op2_warc(spark, sf_dir):
    folder = C.scratch_path(spark, "warc")
    manifest = warc.write_archives(warc.plan_records(C.read_table(spark, sf_dir, "pages")), folder)
    return warc.summed(warc.read_archives(spark, folder, manifest))


ORACLE["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p JOIN k USING (h)
"""


def _list_entries(pages):
    """Dated entries over the hosts of ``pages``: the tables hold no list, so days follow from the hosts' MD5."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).dropna().distinct()
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int")
    base = F.lit("2024-01-01").cast("date")

    def entry(rows, name, verdict, domain, action, days):
        return rows.select(F.lit(name).alias("list"), F.lit(verdict).alias("verdict"), domain.alias("domain"),
                           F.date_add(base, days).alias("day"), F.lit(action).alias("action"))

    host, parent = F.col("host"), F.concat_ws(".", F.slice(F.split("host", r"\."), -2, 2))
    spam = hosts.where(host.rlike("casino|bets|pills|farm|win|track"))
    domains = hosts.where(F.size(F.split("host", r"\.")) >= 2).select(parent.alias("host")).distinct()
    some, blogs = domains.where(number(host) % 3 != 0), hosts.where(host.startswith("blog."))
    first, n = number(host) % 60, number(host) % 200
    return (entry(spam, "spam", "block", host, "add", first).unionAll(entry(spam, "spam", "block", host, "remove", first + 120))
            .unionAll(entry(spam, "spam", "block", host, "add", first + 180))
            .unionAll(entry(some, "rotating", "block", host, "add", n)).unionAll(entry(some, "rotating", "block", host, "remove", n + 45))
            .unionAll(entry(blogs, "partners", "allow", host, "add", F.lit(60))))


@_query
def op6_url_filter(spark, sf_dir):
    pages = C.read_table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"),
                                                         (F.col("page_id") % 365).cast("int")).alias("day"))
    return url_filter.judge(captures, _list_entries(pages)).withColumn("day", F.col("day").cast("string"))


ORACLE["op6_url_filter"] = r"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS day,
         nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''), '') AS url_host
  FROM pages),
host AS (SELECT DISTINCT url_host AS h FROM cap WHERE url_host IS NOT NULL),
dom AS (SELECT DISTINCT array_to_string(string_split(h, '.')[-2:], '.') AS h FROM host WHERE len(string_split(h, '.')) >= 2),
hn AS (SELECT h, CAST('0x' || substr(md5(h), 1, 4) AS INTEGER) AS n FROM host),
dn AS (SELECT h, CAST('0x' || substr(md5(h), 1, 4) AS INTEGER) AS n FROM dom),
span AS (  -- list, verdict, domain, days [since, until)
  SELECT 'spam' AS list, 'block' AS verdict, h AS domain, n % 60 AS since, n % 60 + 120 AS until FROM hn
  WHERE regexp_matches(h, 'casino|bets|pills|farm|win|track')
  UNION ALL SELECT 'spam', 'block', h, n % 60 + 180, NULL FROM hn WHERE regexp_matches(h, 'casino|bets|pills|farm|win|track')
  UNION ALL SELECT 'rotating', 'block', h, n % 200, n % 200 + 45 FROM dn WHERE n % 3 <> 0
  UNION ALL SELECT 'partners', 'allow', h, 60, NULL FROM hn WHERE h LIKE 'blog.%'),
hit AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow') AS blocked
  FROM cap JOIN span ON (url_host = domain OR ends_with(url_host, '.' || domain))
   AND day >= DATE '2024-01-01' + since AND (until IS NULL OR day < DATE '2024-01-01' + until)
  GROUP BY page_id)
SELECT cap.page_id, url, CAST(day AS VARCHAR) AS day, url_host, CAST(coalesce(n, 0) AS BIGINT) AS n_active,
       coalesce(lists, '') AS active_lists, coalesce(blocked, false) AS blocked
FROM cap LEFT JOIN hit USING (page_id)
"""


@_query
def op8_quality_rules(spark, sf_dir):
    docs = C.read_table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.fit(docs, C.read_table(spark, sf_dir, "labels")))


@_query
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(C.read_table(spark, sf_dir, "documents"))


ORACLE["op4_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS same FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM pair JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * same >= 80 * (a.n + b.n - same)),
r AS (SELECT doc_id AS node, doc_id AS part FROM d UNION SELECT v, part FROM r JOIN link ON node = u WHERE part < v)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(part) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY 1, 2
"""


@_query
def op3_html_text(spark, sf_dir):
    return html_text.extract(C.read_table(spark, sf_dir, "pages"))


@_query
def op7_perplexity(spark, sf_dir):
    return perplexity.classify(C.read_table(spark, sf_dir, "documents"), C.read_table(spark, sf_dir, "labels"))


#: CRC-32 of a list of bytes ``x`` in DuckDB; the table ``crc`` has its 256 steps.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda b : list_reduce(range(8), lambda c, i : xor(c >> 1, 3988292384 * (c & 1)), b)) AS t)"""
_BYTES = "list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda p : CAST('0x' || p AS BIGINT))"
_CRC = f"xor(list_reduce({_BYTES}, lambda c, b : xor(c >> 8, t[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295)"


@_query
def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damage(C.read_table(spark, sf_dir, "conversations")))


ORACLE["op13_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc),
d AS (  -- after damage
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE kind <> 0)),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM d),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS k,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) || left(role, 1) AS pair,
         NOT regexp_matches(text, '[^ 	-
]') AS blank,
         regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) NOT IN ('.', '!', '?') AS cut
  FROM b),
f AS (SELECT *, again AND NOT blank AS dup, cut AND NOT blank AND NOT again AS trunc, left(role, 1) AS i FROM o),
s AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(dup) AS duplicate, count_if(trunc) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
-- states of the grammar: e (nothing yet), s, u, a; each holds the cheapest beginning: cost, audit, rows
r(conv_id, k, e, s, u, a) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {{'c': CAST(0 AS BIGINT), 'x': '', 'o': CAST([] AS VARCHAR[])}},
         CAST(NULL AS STRUCT(c BIGINT, x VARCHAR, o VARCHAR[])), CAST(NULL AS STRUCT(c BIGINT, x VARCHAR, o VARCHAR[])),
         CAST(NULL AS STRUCT(c BIGINT, x VARCHAR, o VARCHAR[])) FROM d
  UNION ALL
  SELECT conv_id, k,
         {{'c': e.c + 2, 'x': e.x || 'D', 'o': e.o}},
         list_min(list_filter([
           CASE WHEN s IS NOT NULL THEN {{'c': s.c + 2, 'x': s.x || 'D', 'o': s.o}} END,
           CASE WHEN i = 's' AND stay THEN {{'c': e.c + more, 'x': e.x || 'K', 'o': list_append(e.o, said)}} END], lambda z : z IS NOT NULL)),
         list_min(list_filter([
           CASE WHEN u IS NOT NULL THEN {{'c': u.c + 2, 'x': u.x || 'D', 'o': u.o}} END,
           CASE WHEN stay THEN {{'c': v.c + more + turned_u, 'x': v.x || as_u, 'o': list_append(v.o, to_u)}} END], lambda z : z IS NOT NULL)),
         list_min(list_filter([
           CASE WHEN a IS NOT NULL THEN {{'c': a.c + 2, 'x': a.x || 'D', 'o': a.o}} END,
           CASE WHEN stay THEN {{'c': u.c + more + turned_a, 'x': u.x || as_a, 'o': list_append(u.o, to_a)}} END], lambda z : z IS NOT NULL))
  FROM (SELECT *, list_min(list_filter([a0, {{'c': u.c + 5, 'x': u.x || 'I', 'o': list_append(u.o, 'assistant:')}}], lambda z : z IS NOT NULL)) AS a
        FROM (SELECT *, list_min(list_filter([u0, {{'c': v.c + 5, 'x': v.x || 'I', 'o': list_append(v.o, 'user:')}}], lambda z : z IS NOT NULL)) AS u
              FROM (SELECT r.conv_id, f.k, f.i, r.e, r.s, r.u AS u0, r.a AS a0, NOT (blank OR dup) AS stay, CASE WHEN trunc THEN 5 ELSE 0 END AS more,
                           role || ':' || text AS said, CASE WHEN i = 'u' THEN 0 ELSE 1 END AS turned_u, CASE WHEN i = 'u' THEN 'K' ELSE 'R' END AS as_u,
                           CASE WHEN i = 'u' THEN role ELSE 'user' END || ':' || text AS to_u,
                           CASE WHEN i = 'a' THEN 0 ELSE 1 END AS turned_a, CASE WHEN i = 'a' THEN 'K' ELSE 'R' END AS as_a,
                           CASE WHEN i = 'a' THEN role ELSE 'assistant' END || ':' || text AS to_a,
                           list_min(list_filter([r.e, r.s, r.a], lambda z : z IS NOT NULL)) AS v
                    FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.k = r.k + 1)))),
z AS (  -- what a conversation may end with: nothing, or an assistant (perhaps an inserted one, after an inserted user)
  SELECT ends.conv_id, list_min(list_filter([e, a, CASE WHEN u IS NOT NULL THEN {{'c': u.c + 5, 'x': u.x || 'I', 'o': list_append(u.o, 'assistant:')}} END,
         {{'c': v.c + 10, 'x': v.x || 'II', 'o': list_append(list_append(v.o, 'user:'), 'assistant:')}}], lambda z : z IS NOT NULL)) AS b
  FROM (SELECT conv_id, k, e, u, a, list_min(list_filter([e, s, a], lambda z : z IS NOT NULL)) AS v FROM r) AS ends
  JOIN (SELECT conv_id, n FROM s) AS sizes ON sizes.conv_id IS NOT DISTINCT FROM ends.conv_id WHERE k = n)
SELECT t.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.x, '') AS audit,
       sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) t LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM t.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM t.conv_id
"""


@_query
def op12_spelling(spark, sf_dir):
    return spelling.group_variants(spelling.vocabulary(C.read_table(spark, sf_dir, "documents"), 7, 2, slip=31), 10)


ORACLE["op12_spelling"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
w AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-zÀ-ÿ]+')) AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
h AS (SELECT w, n, {_CRC.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM w, crc),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
g AS (SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM g a JOIN g b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT g.word, v.word, v.n FROM g JOIN v ON v.word = g.rest
  UNION SELECT v.word, g.word, g.n FROM g JOIN v ON v.word = g.rest),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -n, 'form': other}}) AS b FROM near GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 10 * v.n THEN b.form END AS form,
         CASE WHEN -b.less >= 10 * v.n THEN -b.less END AS form_n
  FROM v LEFT JOIN best USING (word)),
up(word, top) AS (SELECT word, word FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.form, CAST(f.form_n AS BIGINT) AS form_n, CAST(f.n_near AS BIGINT) AS n_near, up.top AS root
FROM f JOIN up USING (word) JOIN f l ON l.word = up.top WHERE l.form IS NULL
"""


@_query
def op11_sharding(spark, sf_dir):
    return shard_ring.sharded(C.read_table(spark, sf_dir, "documents"), n_shards=24, vnodes=64)


ORACLE["op11_sharding"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
point AS (
  SELECT CAST('0x' || substr(md5(s || ':' || v), 1, 8) AS BIGINT) AS place, CAST(s AS INTEGER) AS s, v
  FROM range(24) a(s), range(64) b(v)),
ring AS (SELECT list(place ORDER BY place, s, v) AS places, list(s ORDER BY place, s, v) AS shards FROM point),
d AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         {_CRC.format("coalesce(text, '')")} AS text_crc32, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents, crc),
k AS (
  SELECT doc_id, size, text_crc32, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS place, CAST('0x' || substr(h, 9, 2) AS BIGINT) AS round,
         len(list_filter(places, lambda p : p < CAST('0x' || substr(h, 1, 8) AS BIGINT))) % len(places) AS arc FROM d, ring),
o AS (SELECT *, row_number() OVER (ORDER BY round, arc, place, doc_id, text_crc32) AS i, count(*) OVER () AS n FROM k),
walk(i, room, shard) AS (  -- a row at a time: the first point clockwise whose shard has room
  SELECT CAST(0 AS BIGINT), (SELECT list(n // 24 + CASE WHEN s < n % 24 THEN 1 ELSE 0 END ORDER BY s) FROM (SELECT count(*) AS n FROM documents), range(24) a(s)),
         CAST(-1 AS INTEGER)
  UNION ALL
  SELECT i, list_transform(room, lambda x, j : CASE WHEN j = to_shard + 1 THEN x - 1 ELSE x END), to_shard
  FROM (SELECT o.i, walk.room,
               list_filter(list_concat(shards[arc + 1 :], shards), lambda s : walk.room[s + 1] > 0)[1] AS to_shard
        FROM walk JOIN o ON o.i = walk.i + 1, ring))
SELECT doc_id, size, text_crc32, 'rows' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM walk JOIN o USING (i)
"""
