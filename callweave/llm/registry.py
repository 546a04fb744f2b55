"""The queries of this subpackage: opN_<name> for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import divergence, langid, lexical, mainhtml, mixing, neardup, packing, quality, rollup, secrets, simhash, toxicity, webp
from callweave.llm._shared import materialise, prepare, table

COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
#: Documents of fewer tokens, by one tokenizer version, are taken out of that version's totals by op2's last batch.
LEAST_TOKENS = 32


def op4_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(prepare(spark), sf_dir, "documents"))


def op5_main_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract(table(prepare(spark), sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(prepare(spark), sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(prepare(spark), sf_dir, "documents"), neardup.THREE_WORDS)


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM documents JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) ON a = doc_id LEFT JOIN n USING (doc_id)
"""


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(prepare(spark), sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i:i+4] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM c, (SELECT unnest(range(0, 5)) AS k) WHERE c.n > 1 GROUP BY r),
m AS (SELECT w.r, doc_id, text, words, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i-1])) AS n_adjacent FROM w LEFT JOIN rep ON rep.r = w.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 2 * n_dup_lines > n_lines
    OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) > length(regexp_replace(text, '[^a-z]+', '', 'g'))
    OR 10 * n_adjacent > 3 * n_words) AS kept
FROM b
"""


def op1_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.store_and_read(table(prepare(spark), sf_dir, "documents"))


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits with replays: guesses inserted, guesses revised to counts, documents too short to train on deleted."""
    counts = materialise(rollup.token_counts(table(prepare(spark), sf_dir, "documents")), "token-counts")
    totals = rollup.Rollup(spark)
    inserts = counts.select(*rollup.KEYS, F.lit("insert").alias("op"), F.col("guess").alias("tokens"), F.lit(0).alias("was"))
    revised = counts.select(*rollup.KEYS, F.lit("revise").alias("op"), "tokens", F.col("guess").alias("was"))
    deletes = counts.where(F.col("tokens") < LEAST_TOKENS).select(*rollup.KEYS, F.lit("delete").alias("op"), "tokens", F.lit(0).alias("was"))
    totals.commit("1-guesses", inserts)
    totals.commit("2-counts", revised)
    totals.compact()
    totals.commit("2-counts", revised)
    totals.commit("3-short", deletes)
    totals.commit("3-short", deletes)
    return totals.totals()


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::DOUBLE AS weight, 1.5 * sum(source_size) OVER () AS budget FROM s),
o AS (SELECT *, 2.0 * source_size AS most, coalesce(sum(2.0 * source_size) OVER a, 0) AS before, sum(weight) OVER () - coalesce(sum(weight) OVER a, 0) AS open_weight FROM w
  WINDOW a AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (budget - before) / open_weight * weight > most AS is_full FROM o),
l AS (SELECT (max(budget) - coalesce(sum(most) FILTER (is_full), 0)) / sum(weight) FILTER (NOT is_full) AS level FROM f),
t AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE level * weight END AS target FROM f, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
u AS (SELECT d.doc_id, d.source, d.size, rate, source_size, target, k,
  ('0x' || substr(md5((k // 4) || ':' || coalesce(doc_id::VARCHAR, 'null')), (k % 4)::INT * 8 + 1, 8))::BIGINT / 4294967296.0 AS draw
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range(0, 16)) AS k)),
e AS (SELECT source, k, abs(coalesce(sum(size) FILTER (draw < rate - floor(rate)), 0) - max((rate - floor(rate)) * source_size)) AS off FROM u GROUP BY source, k),
b AS (SELECT source, k FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source AND u.k = b.k
"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
f AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
v AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM f, s GROUP BY term, n),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w)::BIGINT * n) // l AS norm FROM d, s WHERE len(w) > 0),
h AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * norm)))::BIGINT AS score FROM i JOIN f USING (term) JOIN v USING (term) JOIN m USING (r) GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM h WHERE score > 0 QUALIFY rank <= 10
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(prepare(spark), sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*)::BIGINT AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::BIGINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(any_value(s.n), 0)::BIGINT AS total FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
l AS (SELECT lang, sum(total)::BIGINT AS total FROM g GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + v.v) AS p
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT c.lang, c.term, 1 + (1000000000 * (sum(c.n)::BIGINT + 1)) // (any_value(l.total) + any_value(v.v)) AS q FROM c JOIN l USING (lang) JOIN v USING (lang) GROUP BY c.lang, c.term),
a AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p)::BIGINT AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0)::BIGINT AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r QUALIFY part = 'pair' OR rank <= 200
"""


def op13_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(prepare(spark), sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_lossless_webp, op2_token_rollup, op3_mix_sources, op4_language_spans, op5_main_html, op6_secret_scan, op7_toxicity, op8_near_duplicates, op9_pack_sequences, op10_quality_rules, op11_lexical_search, op12_source_divergence, op13_simhash_components)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op3_mix_sources": OP3_SQL, "op8_near_duplicates": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_lexical_search": OP11_SQL, "op12_source_divergence": OP12_SQL}
