"""The registered queries of the subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resight.llm import disclosure, divergence, fuzzy_lines, html_text, language, learned_partitions, line_crf, merkle, minhash, mixing, packing, quality_rules, substrings
from resight.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def _held_out() -> Column:
    """Rows kept from learning: crc32 of the id's text leaves 1 when divided by 3 (never for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = line_crf.sample_labels(read(spark, sf_dir, "labels").filter(~_held_out()))
    model = line_crf.train(docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id"))
    return line_crf.score(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.filter(~_held_out()))
    return language.identify(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "spans")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=2)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS x FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(x) >= 2 THEN [x[i] || ' ' || x[i + 1] for i in range(1, len(x))]
    WHEN len(x) = 1 THEN x ELSE [] END)) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), t AS (
  SELECT doc_id, g, n FROM s JOIN n USING (doc_id)
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(node, seen) AS (
  SELECT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
), k AS (
  SELECT node, min(seen) AS component_id FROM r GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id,
  coalesce(k.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k ON k.node = d.doc_id
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(read(spark, sf_dir, "documents"), short=True).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_failed = ~quality_rules.passes(quality_rules.BASE)
    return quality_rules.ledger(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality_rules.passes(quality_rules.STANDARD)).alias("kept"),
        "fail_bits",
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM w)
), r AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclaim
  FROM w LEFT JOIN c USING (doc_id)
), f AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
    + 16 * (word_chars < 3 * n_words)::BIGINT + 32 * (word_chars > 12 * n_words)::BIGINT
    + 64 * (100 * n_capitals > 30 * word_chars)::BIGINT + 128 * (100 * n_exclaim > 50 * n_words)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM f
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, 'null'))[1:12])::BIGINT AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), k AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER b, 0) AS given, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS w,
    1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM k WINDOW b AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT coalesce(first((total - given)::DOUBLE / w ORDER BY cap::DOUBLE / weight, source NULLS LAST)
    FILTER ((total - given)::DOUBLE / w * weight < cap), 0.0) AS level FROM o
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * level) AS target,
    CASE WHEN source_size > 0 THEN least(cap::DOUBLE, weight * level) / source_size ELSE 0.0 END AS rate
  FROM k, l
), f AS (
  SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS fraction FROM t
), x AS (
  SELECT d.doc_id, d.size, d.source, f.source_size, f.target, f.whole, j.j AS turn,
    ((d.u + j.j * (1::BIGINT << 43)) % (1::BIGINT << 48) < f.fraction * 281474976710656.0::DOUBLE)::BIGINT AS extra
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source CROSS JOIN range(32) j(j)
), g AS (
  SELECT source, turn, abs(any_value(whole) * any_value(source_size) + sum(extra * size) - any_value(target)) AS gap
  FROM x GROUP BY source, turn
), b AS (
  SELECT source, first(turn ORDER BY gap, turn) AS turn FROM g GROUP BY source
)
SELECT x.doc_id, x.size, x.source_size, x.target, ((x.whole + x.extra) * x.size)::BIGINT AS taken
FROM x JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.turn = b.turn
"""


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(read(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents
), g AS (
  SELECT doc_id, p, sha256(array_to_string(x[p : p + 34], ' ')) AS g
  FROM (SELECT doc_id, x, unnest(range(1, len(x) - 33)) AS p FROM w WHERE len(x) >= 35)
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1
), q AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM r
), k AS (
  SELECT doc_id, list(q) AS q FROM q GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(x) AS n, coalesce(len(k.q), 0) AS c, x,
    list_distinct(coalesce(k.q, [])) AS q FROM w LEFT JOIN k USING (doc_id)
), e AS (
  SELECT doc_id, string_agg(x[i], ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM w) a
  WHERE NOT EXISTS (SELECT 1 FROM q b WHERE b.doc_id = a.doc_id AND b.q = a.i) GROUP BY doc_id
)
SELECT m.doc_id, n::BIGINT AS n_words, c::BIGINT AS n_removed, sha256(coalesce(e.kept, '')) AS kept_sha256
FROM m LEFT JOIN e USING (doc_id)
"""

def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), v AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS t FROM k GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0)::HUGEINT AS t
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.t + g.v) AS p,
    1 + 1000000000 * (k.n + 1) // (v.t + v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r
QUALIFY part = 'pair' OR rank <= 200
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` by language, and the check of a copy in which every third text is lower-cased."""
    docs = read(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    leaves = docs.select(
        merkle.group_key(F.col("lang")).alias("g"),
        "doc_id",
        merkle.leaf_hash(*fields, F.col("text")).alias("leaf"),
        F.when(changed, merkle.leaf_hash(*fields, lower)).alias("tampered"),
    )
    folded = merkle.folded(F.coalesce("tampered", "leaf"))
    rows = merkle.manifest(leaves, "tampered").withColumn("folded_root", folded)
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT *, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower FROM documents
), x AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front, text, translate(text, upper, lower) AS low FROM t
), crc(doc_id, rest, c) AS (
  SELECT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM documents UNION ALL
  SELECT doc_id, rest[2:], list_reduce([xor(c, ascii(rest))] || range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1))) FROM crc WHERE rest <> ''
), d AS (
  SELECT doc_id, g, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(front || coalesce(strlen(low) || ':' || low, '-')) AS low_leaf, xor(c, 4294967295) % 3 = 0 AS changed
  FROM x JOIN crc USING (doc_id) WHERE rest = ''
), n(g, lvl, idx, h, m) AS (
  SELECT g, 0, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1, leaf, count(*) OVER (PARTITION BY g) FROM d
  UNION ALL
  SELECT g, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value(m + 7) // 8 FROM n WHERE m > 1 GROUP BY g, lvl, idx // 8
), s AS (
  SELECT g, lvl AS depth, h, row_number() OVER (ORDER BY g) - 1 AS idx FROM n WHERE m = 1
), u(lvl, idx, h, m) AS (
  SELECT 0, idx, h, count(*) OVER () FROM s UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value(m + 7) // 8 FROM u WHERE m > 1 GROUP BY lvl, idx // 8
), tree AS (
  SELECT n.g, lvl, n.idx, n.h FROM n WHERE m > 1 UNION ALL
  SELECT s.g, s.depth + u.lvl, u.idx, u.h FROM s, u WHERE u.m > 1
), runs AS (
  SELECT g, lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM tree GROUP BY g, lvl, idx // 8
), f(doc_id, g, lvl, idx, h, proof) AS (
  SELECT doc_id, d.g, 0, n.idx, CASE WHEN changed THEN low_leaf ELSE leaf END, '' FROM d JOIN n ON n.g = d.g AND n.lvl = 0 AND n.h = d.leaf
  UNION ALL
  SELECT f.doc_id, f.g, f.lvl + 1, CASE WHEN f.lvl + 1 = s.depth THEN s.idx ELSE k // 8 END,
    sha256(array_to_string(hs[:k % 8], '') || f.h || array_to_string(hs[k % 8 + 2:], '')),
    proof || array_to_string(hs[:k % 8], '') || array_to_string(hs[k % 8 + 2:], '')
  FROM (SELECT f.*, CASE WHEN f.lvl = 0 AND s.depth = 0 THEN s.idx ELSE f.idx END AS k FROM f JOIN s USING (g)) f
    JOIN s ON s.g = f.g JOIN runs r ON r.g = f.g AND r.lvl = f.lvl AND r.run = f.k // 8
)
SELECT d.doc_id, d.leaf, s.h AS subroot, u.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM d JOIN s USING (g) JOIN u ON u.m = 1
  JOIN f ON f.doc_id = d.doc_id AND f.lvl = s.depth + u.lvl
"""


def op13_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = disclosure.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *[F.size(f"spans_{k}").cast("long").alias(f"n_{k}") for k in disclosure.KINDS],
        F.sha2(disclosure.span_list(*disclosure.KINDS), 256).alias("base_sha256"),
        disclosure.span_list(*disclosure.KINDS, *disclosure.ACTIONS).alias("spans"),
    )


OP13_SQL = r"""
WITH r AS (
  SELECT *, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term,
    '[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\+[0-9][\x20().0-9-]+[0-9]|[0-9]([\x20-]?[0-9]){15,}' AS entity
  FROM (VALUES (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    (3, 'card', '[0-9]([\x20-]?[0-9])+'), (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')) r(k, kind, pattern)
), d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT row, k, regexp_extract_all(t, pattern) AS ms, string_split_regex(t, pattern) AS gs FROM d, r
), x AS (
  SELECT row, k, i, ms[i] AS m, gs[i] AS g FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m)
), y AS (
  SELECT row, k, m, sum(length(g) + length(m)) OVER (PARTITION BY row, k ORDER BY i) AS e, regexp_replace(m, '[^0-9]', '', 'g') AS n FROM x
), z AS (
  SELECT row, k, e - length(m) AS s, e, n FROM y WHERE CASE k WHEN 1 THEN true WHEN 4 THEN length(n) BETWEEN 8 AND 15
    WHEN 2 THEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR right('00' || p, 3) > '255')) = 0
    ELSE length(n) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN i % 2 = 1 THEN n[-i]::INT
      WHEN n[-i]::INT > 4 THEN 2 * n[-i]::INT - 9 ELSE 2 * n[-i]::INT END)) % 10 = 0 END
), c AS (
  SELECT row, regexp_extract_all(t, entity) AS f, string_split_regex(t, entity) AS g FROM d, r WHERE k = 1
), gt AS (
  SELECT row, f, g, list_transform(g, lambda x: regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), term)) AS ts
  FROM c, r WHERE k = 1
), ne AS (
  SELECT row, f[i] AS m, ts[i][-8:] || ts[i + 1][:8] AS terms, regexp_replace(f[i], '[^0-9]', '', 'g') AS n
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM gt)
), near AS (
  SELECT row, terms, list_distinct(terms || list_transform(list_filter(terms, lambda t: length(t) > 3), lambda t: left(t, 3) || '*')) AS features,
    CASE WHEN contains(m, '@') THEN 'email:' || lower(m) WHEN m LIKE '+%' THEN CASE WHEN length(n) BETWEEN 8 AND 15 THEN 'phone:' || n END
      WHEN contains(m, '.') THEN CASE WHEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR right('00' || p, 3) > '255')) = 0 THEN 'ip:' || m END
      WHEN length(n) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN i % 2 = 1 THEN n[-i]::INT
        WHEN n[-i]::INT > 4 THEN 2 * n[-i]::INT - 9 ELSE 2 * n[-i]::INT END)) % 10 = 0 THEN 'card:' || n END AS entity FROM ne
), w AS (
  SELECT DISTINCT entity, terms, features FROM near WHERE entity IS NOT NULL
), pe AS (
  SELECT entity, count(*) AS n_e FROM w GROUP BY entity HAVING count(*) >= 3
), j AS (
  SELECT entity, feature, count(*) AS j FROM (SELECT entity, unnest(features) AS feature FROM w) GROUP BY ALL HAVING count(*) >= 3
), b AS (
  SELECT entity, feature, count(DISTINCT row) AS near FROM (SELECT row, entity, unnest(features) AS feature FROM near) GROUP BY ALL
), dt AS (
  SELECT row, list_distinct(flatten(ts)) AS ts FROM gt
), df AS (
  SELECT feature, count(*) AS docs FROM (SELECT unnest(list_distinct(ts || list_transform(list_filter(ts, lambda t: length(t) > 3),
    lambda t: left(t, 3) || '*'))) AS feature FROM dt) GROUP BY feature
), q AS (
  SELECT DISTINCT feature FROM j JOIN pe USING (entity) JOIN b USING (entity, feature) JOIN df USING (feature), (SELECT count(*)::DOUBLE AS n FROM d)
  WHERE ln(n / n_e) > 0 AND ln(j * n / ((j + docs - near) * n_e)) >= 0.9 * ln(n / n_e)
), a AS (
  SELECT feature AS t, CASE WHEN length(feature) > 3 AND left(feature, 3) || '*' NOT IN (FROM q) THEN 5 ELSE 6 END AS k
  FROM q WHERE feature NOT LIKE '%*'
), l AS (
  SELECT row, gi, gap, translate(gap, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    sum(length(gap) + before) OVER (PARTITION BY row ORDER BY gi) - length(gap) AS start
  FROM (SELECT row, gi, g[gi] AS gap, CASE WHEN gi = 1 THEN 0 ELSE length(f[gi - 1]) END AS before FROM (SELECT *, unnest(range(1, len(g) + 1)) AS gi FROM gt
    SEMI JOIN (SELECT row FROM (SELECT row, unnest(ts) AS t FROM dt) SEMI JOIN a USING (t)) h USING (row)))
), o AS (
  SELECT row, start, ws[i] AS t, sum(length(ps[i]) + length(ws[i])) OVER (PARTITION BY row, gi ORDER BY i) AS e
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT row, gi, start, regexp_extract_all(low, term) AS ws, string_split_regex(low, term) AS ps FROM l, r WHERE k = 1))
), u AS (
  SELECT row, k, s, e FROM z UNION ALL SELECT row, k, start + e - length(t), start + e FROM o JOIN a USING (t)
), v AS (
  SELECT row, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3, count(*) FILTER (k = 4) AS n4,
    string_agg(['email', 'ip', 'card', 'phone'][k] || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 5) AS base,
    string_agg(['email', 'ip', 'card', 'phone', 'generalise', 'remove'][k] || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM u GROUP BY row
)
SELECT doc_id, coalesce(n1, 0)::BIGINT AS n_email, coalesce(n2, 0)::BIGINT AS n_ip, coalesce(n3, 0)::BIGINT AS n_card, coalesce(n4, 0)::BIGINT AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN v USING (row)
"""


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_quality_crf": op2_quality_crf,
    "op3_learned_partitions": op3_learned_partitions,
    "op4_language_id": op4_language_id,
    "op5_minhash": op5_minhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_html_text": op9_html_text,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_disclosure": op13_disclosure,
}
ORACLES: dict[str, str] = {
    "op5_minhash": OP5_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_disclosure": OP13_SQL,
}
