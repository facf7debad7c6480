"""The corpus operators as queries over the test tables, and the SQL they agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    divergence,
    fingerprints,
    langid,
    lsh_forest,
    mixing,
    sanitise,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)
from tillroll.llm.base import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS known
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM d GROUP BY source),
r AS (SELECT *, coalesce(sum(s) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
    sum(s) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a,
    sum(w) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s),
c AS (SELECT *, w * (a - 2 * b) >= 3 * s * ws AS capped FROM r),
o AS (SELECT a - 2 * b AS l, ws FROM c WHERE NOT capped ORDER BY s / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, s, CASE WHEN capped THEN 3.0::DOUBLE * s ELSE (w * o.l)::DOUBLE / o.ws::DOUBLE END AS target FROM c LEFT JOIN o ON true),
x AS (SELECT d.*, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / t.s::DOUBLE ELSE 0.0::DOUBLE END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT x.*, k, ('0x' || substr(md5(known || ':' || (k // 4)), (k % 4) * 8 + 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) AS more
  FROM x, (SELECT unnest(range(16)) AS k)),
e AS (SELECT source, k, abs(floor(any_value(rate)) * any_value(s) + sum(CASE WHEN more THEN size ELSE 0 END)::BIGINT - any_value(target)) AS off
  FROM u GROUP BY source, k),
b AS (SELECT source, arg_min(k, (off, k)) AS k FROM e GROUP BY source)
SELECT doc_id, size, s AS source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source AND u.k = b.k
"""


@query("op10_mixing", MIXING_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


@query("op3_url_filter")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


@query("op6_lsh_forest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_copies(table(spark, sf_dir, "documents"), shingle=4)


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[i:i + 9], ' ') AS p FROM bi),
di AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw)),
h AS (SELECT doc_id, i, di.l, item FROM di JOIN bw ON di.l = bw.l AND array_to_string(w[i:i + di.l - 1], ' ') = p),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS k FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id),
dp AS (SELECT doc_id, lower(unnest(w)) AS term, unnest(range(len(w))) AS at FROM d),
dc AS (SELECT term, count(*) AS n FROM dp GROUP BY term),
q AS (SELECT DISTINCT p, string_split(p, ' ') AS w FROM bw),
k AS (SELECT p, len(w) AS size, lower(unnest(w)) AS term, unnest(range(len(w))) AS at FROM q),
o AS (SELECT k.*, n, count(*) OVER (PARTITION BY p) AS known, row_number() OVER (PARTITION BY p ORDER BY n, k.term, k.at) AS step
  FROM k JOIN dc ON dc.term = k.term),
l AS (SELECT p, size, min(CASE WHEN step = 1 THEN term END) AS one, min(CASE WHEN step = 2 THEN term END) AS two
  FROM o WHERE known = size GROUP BY p, size),
e AS (SELECT DISTINCT x.doc_id, p FROM l JOIN dp x ON x.term = l.one JOIN dp y ON y.term = l.two AND y.doc_id = x.doc_id
    WHERE abs(x.at - y.at) BETWEEN 1 AND 10
  UNION SELECT x.doc_id, p FROM l JOIN dp x ON x.term = l.one WHERE l.two IS NULL),
g AS (SELECT doc_id, count(*) AS n_near FROM e GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_near, 0)::BIGINT AS n_near, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_langid")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_sanitise")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.report(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS (SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
t AS (SELECT lang, term, count(*) AS m FROM o GROUP BY ALL HAVING count(DISTINCT k) >= 30),
l AS (SELECT lang, count(*) AS v, sum(m) AS m FROM t GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT o.lang, source, o.term, count(*) AS c FROM o JOIN t ON o.lang = t.lang AND o.term = t.term GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, t.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (t.m + 5)) // (l.m + 5 * l.v)::HUGEINT AS q
  FROM g JOIN t ON g.lang = t.lang JOIN l ON l.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
    LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
e AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""


@query("op12_divergence", DIVERGENCE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


COLLOCATION_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, w[i:i + k - 1] AS p, count(*)::HUGEINT AS a FROM o GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT f.lang, f.k, f.p, f.a, j, l.a AS l, r.a AS r, (1000000 * f.a * f.a) // (l.a * r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) f
    JOIN f l ON l.lang = f.lang AND l.p = f.p[1:j] JOIN f r ON r.lang = f.lang AND r.p = f.p[j + 1:]),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
x AS (SELECT lang, p, max(a) AS a FROM (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, a FROM f WHERE k = 3) GROUP BY ALL),
s AS (SELECT b.* FROM b LEFT JOIN x ON x.lang = b.lang AND x.p = b.p WHERE x.a IS NULL OR 100 * x.a < 50 * b.a),
r AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM s)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))
