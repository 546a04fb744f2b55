"""Queries over the driver's tables and the SQL that must give the same rows.

The tables hold no source code, so relational operators run through an adapter that
makes the events table look like scanned events, trace lines or code lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave import generated
from callweave.functions import evaluate, ids, predicates, text
from callweave.operators import dispatch, rules
from callweave.operators import events as ev
from callweave.plans import engine, sink
from callweave.sources import files, java, kotlin, kotlin_lines, kotlin_tree
from callweave.streaming import trace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query by its name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _filled(column: str) -> Column:
    """A whole number with -1 for null, so that clients without nullable integers read it as it is."""
    return F.coalesce(F.col(column), F.lit(-1)).alias(column)


# --- adapter: the events table as scanned events -----------------------------------------------------


def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as scanned events; scan_seq is the event's id."""
    kotlin_side, k = F.col("user_id") % 2 == 0, F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return (
        _table(spark, sf_dir, "events")
        .select("event_id", "user_id", "event_type", "props")
        .select(
            F.when(kotlin_side, "kotlin").otherwise("java").alias("language"),
            F.concat(F.lit("com.example.U"), "user_id").alias("fqcn"),
            F.concat(F.lit("m"), F.col("event_id") % 23).alias("method"),
            F.concat(F.lit("m"), F.col("event_id") % 23, F.lit("()")).alias("signature"),
            F.when(kind == "signup", "switch")
            .when(kind == "purchase", F.when(kotlin_side, "when-branch").otherwise("switch-case"))
            .when(kind == "view", "if-true")
            .when(kind == "click", "if-false")
            .otherwise(F.when(kotlin_side, "write").otherwise("throw"))
            .alias("kind"),
            (F.col("event_id") % 400 + 1).cast("int").alias("line"),
            F.when(kind.isin("view", "click"), F.concat(F.lit("k == "), k))
            .when(kind == "signup", "k")
            .when(kind == "purchase", k)
            .otherwise(F.concat(F.lit("v"), F.col("user_id") % 5))
            .alias("condition_text"),
            F.col("event_id").alias("scan_seq"),
        )
    )


EV = """ev AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'kotlin' ELSE 'java' END AS language, 'com.example.U' || user_id AS fqcn, 'm' || (event_id % 23) AS method,
  'm' || (event_id % 23) || '()' AS signature,
  CASE event_type WHEN 'signup' THEN 'switch' WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'when-branch' ELSE 'switch-case' END
    WHEN 'view' THEN 'if-true' WHEN 'click' THEN 'if-false' ELSE CASE WHEN user_id % 2 = 0 THEN 'write' ELSE 'throw' END END AS kind,
  (event_id % 400 + 1)::INT AS line,
  CASE event_type WHEN 'signup' THEN 'k' WHEN 'purchase' THEN json_extract_string(props, '$.k') WHEN 'view' THEN 'k == ' || json_extract_string(props, '$.k')
    WHEN 'click' THEN 'k == ' || json_extract_string(props, '$.k') ELSE 'v' || (user_id % 5) END AS condition_text, event_id AS scan_seq FROM events)"""

FLAGGED = (
    EV
    + """, fl AS (SELECT *, row_number() OVER (PARTITION BY language, fqcn, method, signature ORDER BY line, kind, scan_seq) = 1 AS is_first,
  language = 'kotlin' AND kind = 'when-branch' AND NOT max((language = 'kotlin' AND kind = 'switch')::INT) OVER (PARTITION BY language, fqcn, method, signature)::BOOL AS is_orphan FROM ev)"""
)

RULES = (
    FLAGGED
    + """, ex AS (SELECT *, unnest(list_filter([CASE WHEN is_first THEN 'enter' END, CASE WHEN is_first THEN 'exit' END, CASE WHEN is_orphan THEN 'synthetic' END,
    CASE WHEN kind IN ('if-true', 'if-false') THEN kind WHEN kind = 'switch' THEN 'when' WHEN kind IN ('when-branch', 'switch-case') THEN 'case' WHEN kind = 'write' THEN 'write' END], lambda x: x IS NOT NULL)) AS made FROM fl),
  p AS (SELECT *, made IN ('enter', 'exit') AS at_method, CASE WHEN made = 'synthetic' THEN 'when { … }' ELSE condition_text END AS shown,
    CASE WHEN made = 'synthetic' THEN 'when' WHEN made = 'write' THEN 'write-' || condition_text ELSE made END AS rule_kind FROM ex),
  r AS (SELECT language, fqcn, method, signature, CASE WHEN NOT at_method THEN line END AS line, rule_kind, scan_seq,
    line AS at_line, kind AS at_kind, CASE made WHEN 'enter' THEN 0 WHEN 'exit' THEN 1 WHEN 'synthetic' THEN 2 ELSE 3 END AS sub,
    concat_ws(chr(10), CASE WHEN at_method THEN 'RULE ' || made || '@' || fqcn || '.' || method ELSE 'RULE ' || fqcn || '.' || method || ':' || line || ':' || rule_kind END,
      'CLASS ' || fqcn, 'METHOD ' || method || '(..)', 'HELPER trace.Helper',
      CASE made WHEN 'enter' THEN 'AT ENTRY' WHEN 'exit' THEN 'AT EXIT' WHEN 'write' THEN 'AFTER WRITE $' || condition_text ELSE 'AT LINE ' || line END,
      CASE made WHEN 'if-true' THEN 'IF (' || condition_text || ')' WHEN 'if-false' THEN 'IF (!(' || condition_text || '))' END,
      CASE WHEN at_method THEN 'DO ' || made || '("' || fqcn || '","' || method || '", $LINE)'
        ELSE 'DO ' || CASE WHEN made LIKE 'if-%' THEN 'iff' WHEN made = 'case' THEN 'kase' WHEN made = 'write' THEN 'writeVar' ELSE 'sw' END || '("' || fqcn || '","' || method || '",' || line || ',"' || shown || '"'
          || CASE made WHEN 'if-true' THEN ', true)' WHEN 'if-false' THEN ', false)' WHEN 'write' THEN ', $' || condition_text || ')' ELSE ')' END END,
      'ENDRULE') AS rule_text,
    CASE WHEN NOT at_method THEN fqcn || '.' || method END AS method_key,
    fqcn || '#' || method || ':' || CASE WHEN at_method OR made = 'write' THEN 0 ELSE line END AS shard_key FROM p)"""
)


def _java_hash(expression: str) -> str:
    return f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({expression}, ''), lambda c: unicode(c)::BIGINT)), lambda a, c: (a * 31 + c) & 4294967295)"


# --- rules ------------------------------------------------------------------------------------------


@query(f"WITH {RULES} SELECT language, fqcn, method, signature, coalesce(line, -1) AS line, rule_kind, rule_text, method_key, shard_key FROM r")
def events_to_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.to_rules(scan_events(spark, sf_dir)).select("language", "fqcn", "method", "signature", _filled("line"), "rule_kind", "rule_text", "method_key", "shard_key")


@query(f"WITH {FLAGGED} SELECT language, fqcn, method, signature, kind, line, scan_seq FROM fl WHERE is_first")
def first_seen_entry_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.first_seen(scan_events(spark, sf_dir)).select(*ev.METHOD, "kind", "line", "scan_seq")


@query(
    f"WITH {EV} SELECT language, fqcn, method, signature, line, scan_seq FROM ev e WHERE language = 'kotlin' AND kind = 'when-branch' AND NOT EXISTS "
    "(SELECT 1 FROM ev s WHERE s.language = 'kotlin' AND s.kind = 'switch' AND s.fqcn = e.fqcn AND s.method = e.method AND s.signature = e.signature)"
)
def synthetic_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.orphan_branches(scan_events(spark, sf_dir)).select(*ev.METHOD, "line", "scan_seq")


@query(
    f"WITH {RULES}, c AS (SELECT *, count(*) FILTER (regexp_matches(rule_text, ':if-|:is-|:when|:case')) OVER (PARTITION BY method_key) AS n FROM r) "
    "SELECT fqcn, method, coalesce(line, -1) AS line, rule_kind, method_key FROM c WHERE method_key IS NULL OR n >= 2"
)
def min_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.selected(rules.to_rules(scan_events(spark, sf_dir)), min_branches=2).select("fqcn", "method", _filled("line"), "rule_kind", "method_key")


@query(f"WITH {RULES} SELECT method_key, count(*) FILTER (regexp_matches(rule_text, ':if-|:is-|:when|:case')) AS branches FROM r WHERE method_key IS NOT NULL GROUP BY method_key")
def branch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.branch_counts(rules.to_rules(scan_events(spark, sf_dir)))


@query(f"WITH {EV} SELECT scan_seq, row_number() OVER (PARTITION BY language, fqcn ORDER BY method, line, kind, scan_seq) AS place FROM ev")
def event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.placed(scan_events(spark, sf_dir)).select("scan_seq", "place")


@query(f"WITH {EV} SELECT scan_seq, fqcn FROM ev WHERE line >= 0 AND (starts_with(fqcn, 'com.example.U1') OR starts_with(fqcn, 'com.example.U22'))")
def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.usable(scan_events(spark, sf_dir), ["com.example.U1", "com.example.U22"]).select("scan_seq", "fqcn")


@query(f"WITH {EV} SELECT scan_seq, condition_text FROM ev WHERE kind = 'write' AND condition_text IN ('v0', 'v2')")
def tracked_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.tracked_writes(scan_events(spark, sf_dir), ["v0", "v2"]).select("scan_seq", "condition_text")


@query(f"WITH {EV} SELECT fqcn, method FROM ev WHERE language = 'java' EXCEPT SELECT fqcn, method FROM ev WHERE language = 'java' AND kind = 'if-true'")
def missing_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    java_events = scan_events(spark, sf_dir).where("language = 'java'")
    return ev.missing_methods(java_events, java_events.where("kind = 'if-true'"))


@query(f"WITH {EV} SELECT language, scan_seq FROM ev WHERE kind = 'switch' UNION ALL SELECT language, scan_seq FROM ev WHERE language = 'java'")
def union_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scan_events(spark, sf_dir)
    return ev.union_all(events.where("kind = 'switch'"), events.where("language = 'java'")).select("language", "scan_seq")


@query(f"WITH {EV} SELECT DISTINCT language, fqcn, method, signature FROM ev WHERE language = 'kotlin' AND kind = 'switch'")
def methods_with_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.methods_with_switch(scan_events(spark, sf_dir))


@query(f"WITH {RULES} SELECT shard, count(*) AS n, sum(strlen(rule_text) + 2)::BIGINT AS bytes FROM (SELECT *, ({_java_hash('shard_key')} & 2147483647) % 8 AS shard FROM r) GROUP BY shard")
def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = dispatch.sharded(rules.to_rules(scan_events(spark, sf_dir)), 8)
    return dealt.groupBy(F.col("shard").cast("bigint").alias("shard")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("rule_text") + 2).cast("bigint").alias("bytes"))


def _rotated_sql(header_bytes: int, max_bytes: int, shards: int) -> str:
    """CTEs that end in t, the rules with shard and rotation: each file begins at the first rule that overflows the one before."""
    return f"""WITH RECURSIVE {RULES}, d AS (SELECT *, ({_java_hash('shard_key')} & 2147483647) % {shards} AS shard, strlen(rule_text) + 2 AS bytes FROM r),
  o AS (SELECT *, row_number() OVER w AS k, sum(bytes) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM d WINDOW w AS (PARTITION BY shard ORDER BY language, fqcn, method, at_line, at_kind, scan_seq, sub)),
  f AS (SELECT DISTINCT shard, 1 AS rotation, 1::BIGINT AS k, 0::BIGINT AS base, 0::BIGINT AS least FROM o
    UNION ALL SELECT f.shard, f.rotation + 1, min(o.k), min(o.upto - o.bytes)::BIGINT, min(o.k) FROM f JOIN o ON o.shard = f.shard AND o.k > f.least AND o.upto - f.base > {max_bytes - header_bytes} GROUP BY f.shard, f.rotation),
  s AS (SELECT shard, k, max(rotation) AS rotation FROM f GROUP BY shard, k),
  t AS (SELECT o.shard, s.rotation, o.k, o.rule_text, o.bytes FROM o ASOF JOIN s ON o.shard = s.shard AND o.k >= s.k)"""


@query(f"{_rotated_sql(60, 65_536, 4)} SELECT shard, rotation, count(*) AS n, sum(bytes)::BIGINT AS bytes FROM t GROUP BY shard, rotation")
def shard_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = dispatch.sharded(dispatch.selected(rules.to_rules(scan_events(spark, sf_dir))), 4)
    turned = dispatch.rotated(dealt, 60, 65_536, 4)
    return turned.groupBy("shard", "rotation").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


#: What the SQL takes a file to begin with, and to hold where its shard has no rules, in the words that runs must write.
HEAD_SQL = "'# Generated by callweave' || chr(10) || '# Helper: trace.Helper' || chr(10) || chr(10)"


@query(
    f"{_rotated_sql(49, 65_536, 4)}, n AS (SELECT shard, rotation, string_agg(rule_text || chr(10) || chr(10), '' ORDER BY k) AS body FROM t GROUP BY ALL "
    "UNION ALL SELECT s, 1, '# No matching sources were found.' || chr(10) FROM range(4) r(s) WHERE s NOT IN (SELECT shard FROM t) "
    "UNION ALL SELECT DISTINCT shard, 1, '' FROM t WHERE shard NOT IN (SELECT shard FROM t WHERE rotation = 1)) "
    f"SELECT format('tracing-{{:04d}}-{{:05d}}.btm', shard + 1, rotation) AS file, length({HEAD_SQL} || body)::BIGINT AS chars, md5({HEAD_SQL} || body) AS digest FROM n"
)
def file_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every output file, told by its length and digest."""
    head = rules.header("callweave", "trace.Helper", [], [])
    dealt = dispatch.sharded(dispatch.selected(rules.to_rules(scan_events(spark, sf_dir))), 4)
    lines = dispatch.file_lines(dispatch.rotated(dealt, len(head.encode()), 65_536, 4), head, "tracing-", 4, True)
    return sink.contents(lines).select("file", F.length("content").cast("bigint").alias("chars"), F.md5("content").alias("digest"))


# --- identifiers ------------------------------------------------------------------------------------

LINE_KEY = "'com.example.P' || l_partkey || '#m' || (l_suppkey % 23) || ':' || l_linenumber"


@query(f"SELECT l_orderkey, l_linenumber, ({_java_hash(LINE_KEY)} & 2147483647) % 8 AS shard FROM lineitem")
def stable_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ids.shard_key(F.concat(F.lit("com.example.P"), "l_partkey"), F.concat(F.lit("m"), F.col("l_suppkey") % 23), F.col("l_linenumber"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ids.stable_shard(key, 8).cast("bigint").alias("shard"))


ORDER_PARTS = ["'com.example.O' || o_custkey", "'m' || (o_orderkey % 23)", "'k == ' || (o_orderkey % 7)"]


@query(
    "SELECT o_orderkey, lower(to_hex(((((((31 + a) & 4294967295) * 31 + b) & 4294967295) * 31 + c) & 4294967295) * 31 + d & 4294967295)) AS rule_id FROM "
    f"(SELECT o_orderkey, {_java_hash(ORDER_PARTS[0])} AS a, {_java_hash(ORDER_PARTS[1])} AS b, o_orderkey % 400 + 1 AS c, {_java_hash(ORDER_PARTS[2])} AS d FROM orders)"
)
def rule_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    made = ids.rule_id(F.concat(F.lit("com.example.O"), "o_custkey"), F.concat(F.lit("m"), k % 23), k % 400 + 1, F.concat(F.lit("k == "), k % 7))
    return _table(spark, sf_dir, "orders").select("o_orderkey", made.alias("rule_id"))


# --- files and text ---------------------------------------------------------------------------------


@query("SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS rel_path FROM pages WHERE regexp_matches(regexp_replace(url, '^[a-z]+://', ''), '^.*/en/.*$|^[^/]*\\.com/.*$') AND NOT regexp_matches(regexp_replace(url, '^[a-z]+://', ''), '^.*\\.html$')")
def path_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("rel_path"))
    return files.by_globs(pages, ["**/en/**", "*.com/**"], ["**.html"])


@query("SELECT doc_id, strlen(text) AS size_bytes FROM documents WHERE strlen(text) <= 2000")
def size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("size_bytes"))
    return files.by_size(docs, 2000)


@query("SELECT doc_id AS path, unnest(range(1, len(parts) + 1)) AS n, unnest(parts) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents)")
def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = files.lines_of(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text"))
    return out.withColumn("n", F.col("n").cast("bigint"))


@query(
    "WITH l AS (SELECT page_id AS path, unnest(range(1, len(parts) + 1)) AS n, unnest(parts) AS line FROM (SELECT page_id, string_split(html, '>') AS parts FROM pages)) "
    "SELECT path, n, sum(length(line) - length(replace(line, '{', '')) - length(line) + length(replace(line, '}', ''))) OVER (PARTITION BY path ORDER BY n)::BIGINT AS depth FROM l"
)
def brace_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("path"), F.posexplode(F.split("html", ">")).alias("k", "line"))
    return ev.brace_depth(lines.select("path", (F.col("k") + 1).cast("bigint").alias("n"), "line")).select("path", "n", F.col("depth").cast("bigint").alias("depth"))


@query("SELECT doc_id, (1 + length(b) - length(replace(b, chr(10), '')))::BIGINT AS line FROM (SELECT doc_id, left(text, n_chars // 2) AS b FROM documents)")
def offset_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return _table(spark, sf_dir, "documents").select("doc_id", text.line_at(F.col("text"), half).cast("bigint").alias("line"))


@query("SELECT path, n, split_part(line, '//', 1) AS code FROM (SELECT page_id AS path, unnest(range(1, len(parts) + 1)) AS n, unnest(parts) AS line FROM (SELECT page_id, string_split(html, chr(10)) AS parts FROM pages))")
def strip_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.lines_of(_table(spark, sf_dir, "pages").select(F.col("page_id").alias("path"), F.col("html").alias("text")))
    return lines.select("path", F.col("n").cast("bigint").alias("n"), text.strip_line_comment(F.col("line")).alias("code"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS plain FROM documents")
def collapse_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", text.collapse_spaces(F.col("text")).alias("plain"))


@query(
    "SELECT page_id, replace(replace(replace(replace(replace(c, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') AS escaped FROM "
    "(SELECT page_id, CASE WHEN length(html) > 400 THEN left(html, 400) || '…' ELSE html END AS c FROM pages)"
)
def escape_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", text.escape(F.col("html"), 400).alias("escaped"))


@query("SELECT doc_id, coalesce(replace(replace(CASE WHEN length(text) > 300 THEN left(text, 300) || '…' ELSE text END, chr(10), '\\n'), chr(13), '\\r'), 'null') AS shown FROM documents")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", text.preview(F.col("text")).alias("shown"))


@query("SELECT c_custkey, '[' || array_to_string([c_name, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, 'null')], ', ') || ']' AS args FROM customer")
def argument_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.array("c_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")))
    return _table(spark, sf_dir, "customer").select("c_custkey", text.argument_list(values).alias("args"))


@query("SELECT n_nationkey, format('t-{:04d}', n_nationkey + 1) || CASE WHEN n_regionkey > 0 THEN format('-{:05d}', n_regionkey) ELSE '' END || '.btm.gz' AS name FROM nation")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select("n_nationkey", text.file_name("t-", F.col("n_nationkey"), F.col("n_regionkey"), True).alias("name"))


@query("SELECT p_partkey, regexp_replace(name, '\\.[^.]*$', '') AS stem FROM (SELECT p_partkey, p_brand || '.' || p_size || '.kt' AS name FROM part)")
def strip_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_brand", F.lit("."), "p_size", F.lit(".kt"))
    return _table(spark, sf_dir, "part").select("p_partkey", text.strip_extension(name).alias("stem"))


@query("SELECT n_nationkey, 'com.n' || n_regionkey AS package FROM nation")
def package_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.lit("// head\n  package com.n"), "n_regionkey", F.lit(" ;\nclass "), F.initcap("n_name"), F.lit(" {}\npackage later;"))
    return _table(spark, sf_dir, "nation").select("n_nationkey", files.package_of(source, "java").alias("package"))


# --- code lines -------------------------------------------------------------------------------------

CODE = """code AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'when (k) {' WHEN 'purchase' THEN '  ' || k || ' -> return v' WHEN 'view' THEN 'if (k == ' || k || ') x = ' || k
  WHEN 'click' THEN 'throw Oops(' || k || ')' ELSE 'v' || (user_id % 5) || ' = f(' || k || ') // note' END AS line FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))"""


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    line = (
        F.when(kind == "signup", F.lit("when (k) {"))
        .when(kind == "purchase", F.concat(F.lit("  "), k, F.lit(" -> return v")))
        .when(kind == "view", F.concat(F.lit("if (k == "), k, F.lit(") x = "), k))
        .when(kind == "click", F.concat(F.lit("throw Oops("), k, F.lit(")")))
        .otherwise(F.concat(F.lit("v"), F.col("user_id") % 5, F.lit(" = f("), k, F.lit(") // note")))
    )
    return _table(spark, sf_dir, "events").select("event_id", line.alias("line"))


@query(
    f"WITH {CODE}, s AS (SELECT event_id, split_part(line, '//', 1) AS line FROM code), "
    "found AS (SELECT event_id, unnest(['if-true', 'if-false']) AS kind, regexp_extract(line, '\\bif\\s*\\(([^)]*)\\)', 1) AS shown FROM s WHERE regexp_matches(line, '\\bif\\s*\\(') "
    "UNION ALL SELECT event_id, 'switch', regexp_extract(line, '\\bwhen\\s*\\(([^)]*)\\)', 1) FROM s WHERE regexp_matches(line, '\\bwhen\\s*\\(') "
    "UNION ALL SELECT event_id, 'when-branch', trim(split_part(line, '->', 1)) FROM s WHERE contains(line, '->') "
    "UNION ALL SELECT event_id, 'return', NULL FROM s WHERE regexp_matches(line, '(^|\\W)return(\\W|$)') "
    "UNION ALL SELECT event_id, 'throw', trim(regexp_extract(line, '\\bthrow\\s+(.+)', 1)) FROM s WHERE regexp_matches(line, '\\bthrow\\s+.') "
    "UNION ALL SELECT event_id, 'write', regexp_extract(line, '([a-z]\\w*) = ', 1) FROM s WHERE regexp_matches(line, '[a-z]\\w* = ')) SELECT * FROM found"
)
def branch_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of single lines, each read as a file of its own."""
    code = code_lines(spark, sf_dir).select("event_id", F.lit(0).alias("row"), text.strip_line_comment(F.col("line")).alias("code"))
    return kotlin_lines.line_events(code, ["event_id"]).select("event_id", "kind", "shown")


@query(f"WITH {CODE} SELECT event_id, regexp_extract(line, '([a-z]\\w*) = ', 1) AS name FROM code WHERE regexp_matches(line, '[a-z]\\w* = ')")
def writes_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("line", F.lit(kotlin.WRITE.pattern), F.lit(1))
    return code_lines(spark, sf_dir).select("event_id", F.explode(found).alias("name"))


FILES = f"""f AS (SELECT user_id, event_id // {generated.SPAN} AS span, event_id AS e, event_type, json_extract_string(props, '$.k') AS k, 'U' || user_id || 'x' || (event_id // {generated.SPAN}) AS c,
  row_number() OVER (PARTITION BY user_id, event_id // {generated.SPAN} ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id, event_id // {generated.SPAN}) AS size FROM events)"""


def _found(language: str, facts: str, chosen: str, beside: str = "") -> str:
    """SQL for what a scanner finds in generated files, from facts (event type, class, method, signature, kind, line of the eight, text); @n is a line end.

    `beside` lists (kind, signature, text) of the function that stands beside a Kotlin class."""
    fill = lambda c: f"replace(replace(replace(replace({c}, '@c', c), '@e', e::VARCHAR), '@k', k), '@n', chr(10))"
    names = f"'{language}' AS language, 'com.example.p' || (user_id % 3) || '.' || {fill('owner')} AS fqcn, {fill('method')} AS method, {fill('signature')} AS signature, kind"
    out = f"SELECT {names}, CASE WHEN kind IN ('enter', 'exit') THEN -1 ELSE 4 + 8 * (n - 1) + ln END AS line, {fill('shown')} AS condition_text FROM f JOIN (VALUES {facts}) x(event_type, owner, method, signature, kind, ln, shown) USING (event_type) WHERE {chosen}"
    if beside:
        out += f" UNION ALL SELECT '{language}', 'com.example.p' || (user_id % 3) || '.' || c || 'Kt', 'top', signature, kind, CASE WHEN kind IN ('enter', 'exit') THEN -1 ELSE 6 + 8 * size END, shown FROM (SELECT DISTINCT user_id, span, c, size FROM f), (VALUES {beside}) x(kind, signature, shown) WHERE {chosen}"
    return out


KOTLIN_FACTS = """('view', '@c', 'm@e', 'm@e(Int,List<String>)', 'if-true', 1, 'a > @k && b.isEmpty()'), ('view', '@c', 'm@e', 'm@e(Int,List<String>)', 'if-false', 1, 'a > @k && b.isEmpty()'),
  ('view', '@c', 'm@e', 'm@e(Int,List<String>)', 'write', 3, 'approved'), ('view', '@c', 'm@e', 'm@e(Int,List<String>)', 'throw', 5, 'IllegalStateException("n@k")'),
  ('signup', '@c$N@e', 'go', 'go(String)', 'switch', 2, 'k'), ('signup', '@c$N@e', 'go', 'go(String)', 'return', 2, NULL), ('signup', '@c$N@e', 'go', 'go(String)', 'when-branch', 3, '"@k"'), ('signup', '@c$N@e', 'go', 'go(String)', 'when-branch', 4, 'else'),
  ('purchase', '@c', 'outer@e', 'outer@e()', 'if-true', 2, 'p == @k'), ('purchase', '@c', 'outer@e', 'outer@e()', 'if-false', 2, 'p == @k'), ('purchase', '@c', 'outer@e', 'outer@e()', 'return', 2, NULL),
  ('purchase', '@c', 'outer@e', 'outer@e()', 'write', 5, 'y'), ('purchase', '@c', 'outer@e', 'outer@e()', 'return', 6, NULL),
  ('click', '@c', 's@e', 's@e()', 'switch', 1, NULL), ('click', '@c', 's@e', 's@e()', 'when-branch', 2, 'a == @k'), ('click', '@c', 's@e', 's@e()', 'when-branch', 3, 'else'),
  ('click', '@c', 's@e', 's@e()', 'if-true', 6, 'z is T@k'), ('click', '@c', 's@e', 's@e()', 'if-false', 6, 'z is T@k'), ('click', '@c', 's@e', 's@e()', 'write', 6, 't'),
  ('error', '@c', 'g@e', 'g@e()', 'throw', 1, 'Oops("@k")'), ('error', '@c$O@e', 'h', 'h(Int)', 'write', 5, 'approved')"""
JAVA_FACTS = """('view', '@c', 'm@e', 'm@e(int, List<String>)', 'if-true', 1, 'a > @k && b.isEmpty()'), ('view', '@c', 'm@e', 'm@e(int, List<String>)', 'if-false', 1, 'a > @k && b.isEmpty()'),
  ('view', '@c', 'm@e', 'm@e(int, List<String>)', 'throw', 4, 'new IllegalStateException("n@k")'), ('view', '@c', 'm@e', 'm@e(int, List<String>)', 'return', 6, NULL),
  ('signup', '@c$N@e', 'go', 'go(String)', 'switch', 2, 'k'), ('signup', '@c$N@e', 'go', 'go(String)', 'switch-case', 3, 'case "@k"'), ('signup', '@c$N@e', 'go', 'go(String)', 'switch-case', 4, 'default'),
  ('signup', '@c$N@e', 'go', 'go(String)', 'return', 3, NULL), ('signup', '@c$N@e', 'go', 'go(String)', 'return', 4, NULL),
  ('purchase', '@c', 's@e', 's@e()', 'if-true', 2, 'z'), ('purchase', '@c', 's@e', 's@e()', 'if-true', 5, 'i == @k'),
  ('click', '@c', 'c@e', 'c@e(String...)', 'if-true', 1, 'names == null'), ('click', '@c', 'c@e', 'c@e(String...)', 'if-false', 1, 'names == null'), ('click', '@c', 'c@e', 'c@e(String...)', 'return', 2, NULL),
  ('click', '@c', 'c@e', 'c@e(String...)', 'if-true', 3, 'names.length == @k'), ('click', '@c', 'c@e', 'c@e(String...)', 'if-true', 3, 'names.length == @k'),
  ('error', '@c$I@e', 'h', 'h(int)', 'throw', 2, 'new Oops(@k)'), ('error', '@c$I@e', 'h', 'h(int)', 'return', 3, NULL), ('error', '@c$I@e', 'run', 'run()', 'throw', 2, 'new Oops(@k)')"""


@query(f"WITH {FILES} {_found('kotlin', KOTLIN_FACTS, 'user_id % 3 < 2', chr(40) + repr('write') + ', ' + repr('top(Int)') + ', ' + repr('approved') + chr(41))} UNION ALL {_found('java', JAVA_FACTS, 'user_id % 3 < 2')}")
def scan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of generated Kotlin and Java files in two of three packages: nested classes, local functions, conditions over two lines, whens without a subject."""
    wanted, sources = ["com.example.p0", "com.example.p1"], generated.sources(_table(spark, sf_dir, "events"))
    found = engine.kotlin_events(sources.where("language = 'kotlin'"), ["path"], wanted)
    found = found.unionByName(engine._scan_files(sources.where("language = 'java'"), engine.EVENT_FIELDS, lambda _, text, name: java.scan(text, name, wanted)))
    return found.select(*(c for c in engine.EVENT_FIELDS if c != "line"), F.col("line").cast("bigint").alias("line"))


def _rule_facts(rows: str, methods: list[tuple[str, str, str]]) -> str:
    """Facts with an enter and an exit for each (event type, class, method)."""
    ends = [f"('{e}', '{c}', '{m}', '', '{kind}', 0, NULL)" for e, c, m in methods for kind in ("enter", "exit")]
    return ", ".join([*ends, rows])


# the method pattern takes a branch at the start of a line for a method of that name, and a condition ends at the first parenthesis
SWITCH = ", ".join(f"('signup', '{c}', '{m}', '', {fact})" for c in ("@c", "N@e") for m, facts in (("go", ("'when', 2, 'k'", "'case', 3, 'case \"@k\"'", "'case', 4, 'default'")), ("switch", ("'case', 3, 'case \"@k\"'", "'case', 4, 'default'"))) for fact in facts)
REGEX_FACTS = _rule_facts(
    SWITCH
    + """, ('view', '@c', 'm@e', '', 'if-true', 1, 'a > @k && b.isEmpty('), ('view', '@c', 'm@e', '', 'if-false', 1, 'a > @k && b.isEmpty('),
  ('purchase', '@c', 's@e', '', 'if-true', 2, 'z'), ('purchase', '@c', 's@e', '', 'if-false', 2, 'z'), ('purchase', '@c', 's@e', '', 'if-true', 5, 'i == @k'), ('purchase', '@c', 's@e', '', 'if-false', 5, 'i == @k'),
  ('click', '@c', 'c@e', '', 'if-true', 1, 'names == null'), ('click', '@c', 'c@e', '', 'if-false', 1, 'names == null'), ('click', '@c', 'c@e', '', 'if-true', 3, 'names.length == @k'), ('click', '@c', 'c@e', '', 'if-false', 3, 'names.length == @k')""",
    [("view", "@c", "m@e"), ("purchase", "@c", "s@e"), ("purchase", "@c", "if"), ("click", "@c", "c@e"), ("click", "@c", "if"), ("error", "@c", "h"), *(("signup", c, m) for c in ("@c", "N@e") for m in ("go", "switch"))],
)


@query(f"WITH {FILES} SELECT fqcn, method, kind AS rule_kind, line, condition_text FROM ({_found('java', REGEX_FACTS, 'user_id % 3 = 1')})")
def regex_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that patterns find in the generated Java files of one package."""
    sources = generated.sources(_table(spark, sf_dir, "events")).where("language = 'java'")
    rows = engine._scan_files(sources, engine.ROW_FIELDS, lambda _, text, __: (("java", *r) for r in java.regex_rules(text, "com.example.p1")))
    return rows.select("fqcn", "method", "rule_kind", F.coalesce("line", F.lit(-1)).cast("bigint").alias("line"), "condition_text")


LEGACY_FACTS = _rule_facts(
    """('view', '@c', 'm@e', '', 'if-true', 1, 'a > @k &&@n            b.isEmpty()'), ('view', '@c', 'm@e', '', 'if-false', 1, 'a > @k &&@n            b.isEmpty()'), ('view', '@c', 'm@e', '', 'write-approved', 3, 'approved'),
  ('signup', '@c$N@e', 'go', '', 'when', 2, 'k'), ('signup', '@c$N@e', 'go', '', 'case', 3, '"@k"'), ('signup', '@c$N@e', 'go', '', 'case', 4, 'else'),
  ('purchase', '@c', 'outer@e', '', 'if-true', 2, 'p == @k'), ('purchase', '@c', 'outer@e', '', 'if-false', 2, 'p == @k'),
  ('click', '@c', 's@e', '', 'when', 1, NULL), ('click', '@c', 's@e', '', 'case', 2, 'a == @k'), ('click', '@c', 's@e', '', 'case', 3, 'else'), ('click', '@c', 's@e', '', 'if-true', 6, 'z is T@k'), ('click', '@c', 's@e', '', 'if-false', 6, 'z is T@k'),
  ('click', '@c', 's@e', '', 'is-true', 6, 'z is T@k'), ('click', '@c', 's@e', '', 'is-false', 6, 'z is T@k'), ('error', '@c$O@e', 'h', '', 'write-approved', 5, 'approved')""",
    [("view", "@c", "m@e"), ("signup", "@c$N@e", "go"), ("purchase", "@c", "outer@e"), ("click", "@c", "s@e"), ("error", "@c", "g@e"), ("error", "@c$O@e", "h")],
)
LEGACY_BESIDE = "('enter', '', NULL), ('exit', '', NULL), ('write-approved', '', 'approved')"


@query(f"WITH {FILES} SELECT fqcn, method, kind AS rule_kind, line, condition_text FROM ({_found('kotlin', LEGACY_FACTS, 'user_id % 3 = 2', LEGACY_BESIDE)})")
def legacy_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older mode's rules of the generated Kotlin files of one package, with one tracked variable."""
    sources = generated.sources(_table(spark, sf_dir, "events")).where("language = 'kotlin'")
    rows = engine._scan_files(sources, engine.ROW_FIELDS, lambda _, text, name: (("kotlin", *r) for r in kotlin_tree.legacy_rules(text, name, "com.example.p2", {"approved"})))
    return rows.select("fqcn", "method", "rule_kind", F.coalesce("line", F.lit(-1)).cast("bigint").alias("line"), "condition_text")


# --- predicates -------------------------------------------------------------------------------------

E = predicates.EVALUATOR
#: Conditions of line items by order line: text, kind, inline form, translation, truth; @p, @q, @f, @s are part, quantity, return flag and line status.
CONDITIONS = [
    ("part == @p", "equals", "part == @p", "@E.ifEq(part, @p)", "true"),
    ("(flag == '@f')", "equals", "flag == '@f'", "@E.ifEq(flag, '@f')", "true"),
    ("item instanceof p.T@p", "instanceof", "item instanceof p.T@p", '@E.ifInstanceOf(item, "p.T@p")', "@p % 2 = 0"),
    ("part == @p && flag == 'R' || qty == @q", "and", "(part == @p) AND ((flag == 'R') OR (qty == @q))", "@E.or(@E.and(@E.ifEq(part, @p), @E.ifEq(flag, 'R')), @E.ifEq(qty, @q))", "true"),
    ("part == @p && flag == 'R'", "and", "(part == @p) AND (flag == 'R')", "@E.and(@E.ifEq(part, @p), @E.ifEq(flag, 'R'))", "'@f' = 'R'"),
    ("part == 0 || flag == 'N'", "or", "(part == 0) OR (flag == 'N')", "@E.or(@E.ifEq(part, 0), @E.ifEq(flag, 'N'))", "@p = 0 OR '@f' = 'N'"),
    ("status != '@s'", "original", "status != '@s'", "!@E.ifEq(status, '@s')", "false"),
    ("(part == 0 || (qty != @q && flag == 'A')) && status == 'O'", "original", "(part == 0 || (qty != @q && flag == 'A')) && status == 'O'", "@E.and(@E.or(@E.ifEq(part, 0), @E.and(!@E.ifEq(qty, @q), @E.ifEq(flag, 'A'))), @E.ifEq(status, 'O'))", "@p = 0 AND '@s' = 'O'"),
    ("part == @p || (status == 'F' && (flag == 'A' || flag == 'R'))", "original", "part == @p || (status == 'F' && (flag == 'A' || flag == 'R'))", "@E.or(@E.ifEq(part, @p), @E.and(@E.ifEq(status, 'F'), @E.or(@E.ifEq(flag, 'A'), @E.ifEq(flag, 'R'))))", "true"),
    ("weight(@q) == @p", "original", "weight(@q) == @p", "true", "true"),
    ('name == "x && @p"', "original", 'name == "x && @p"', '@E.ifEq(name, "x && @p")', "false"),
    ("LIMIT_@p == MAX_VALUE", "equals", "LIMIT_@p == MAX_VALUE", "@E.ifEq(LIMIT_@p, MAX_VALUE)", "false"),
    ("ready", "original", "ready", "true", "true"),
]


def _conditions_sql() -> str:
    quoted = lambda v: "'" + v.replace("@E", E).replace("'", "''") + "'"
    rows = ", ".join("(" + ", ".join([str(k), *map(quoted, row[:4])]) + ")" for k, row in enumerate(CONDITIONS))
    fill = lambda c: f"replace(replace(replace(replace({c}, '@p', l_partkey::VARCHAR), '@q', l_quantity::BIGINT::VARCHAR), '@f', l_returnflag), '@s', l_linestatus)"
    holds = " ".join(f"WHEN {k} THEN " + row[4].replace("'@f'", "l_returnflag").replace("'@s'", "l_linestatus").replace("@p", "l_partkey") for k, row in enumerate(CONDITIONS))
    return (
        f"SELECT l_orderkey, l_linenumber, {fill('shown')} AS condition_text, kind AS strategy_kind, {fill('inlined')} AS inline_form, {fill('translated')} AS translated, CASE form {holds} END AS holds "
        f"FROM (SELECT *, (l_orderkey + l_linenumber) % {len(CONDITIONS)} AS form FROM lineitem) JOIN (VALUES {rows}) x(form, shown, kind, inlined, translated) USING (form)"
    )


@query(_conditions_sql())
def translate_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition on each line item: its strategy, its inline form, its translation, and whether that holds for the item.

    Texts are parsed once for each shape, of which there are as many as conditions, flags and statuses make; the truth is
    that of the translated calls, read as expressions over the item's columns."""
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("l_quantity"), "l_returnflag", "l_linestatus")
    form = F.array(*(F.lit(row[0]) for row in CONDITIONS))[((F.col("l_orderkey") + F.col("l_linenumber")) % len(CONDITIONS)).cast("int")]
    for mark, value in (("@p", F.col("l_partkey").cast("string")), ("@q", F.col("l_quantity").cast("string")), ("@f", F.col("l_returnflag")), ("@s", F.col("l_linestatus"))):
        form = F.replace(form, F.lit(mark), value)
    told = items.withColumn("condition_text", form)
    names = {"part": F.col("l_partkey").cast("string"), "qty": F.col("l_quantity").cast("string"), "flag": F.col("l_returnflag"), "status": F.col("l_linestatus")}
    holds = predicates.evaluated(F.col("translated"), names, F.col("l_partkey") % 2 == 0)
    return predicates.with_forms(told, few=True).select("l_orderkey", "l_linenumber", "condition_text", "strategy_kind", "inline_form", "translated", holds.alias("holds"))


@query(f"WITH {EV} SELECT scan_seq, '{E}.ifEq(k, ' || split_part(condition_text, ' == ', 2) || ')' AS guard FROM ev WHERE language = 'kotlin' AND kind IN ('if-true', 'if-false')")
def safe_mode_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    guarded = rules.with_guards(scan_events(spark, sf_dir), rules.Style(safe_mode=True, force_helper=True))
    return guarded.where("language = 'kotlin' and kind in ('if-true', 'if-false')").select("scan_seq", "guard")


OWN_ID = f"lower(to_hex(((((((31 + {_java_hash('fqcn')}) & 4294967295) * 31 + {_java_hash('method')}) & 4294967295) * 31 + line) & 4294967295) * 31 + {_java_hash('shown')} & 4294967295))"


@query(
    f"WITH {EV}, c AS (SELECT *, 'k != ' || split_part(condition_text, ' == ', 2) AS shown FROM ev WHERE language = 'kotlin' AND kind IN ('if-true', 'if-false')), i AS (SELECT *, {OWN_ID} AS id FROM c) "
    f"SELECT scan_seq, 'IF (' || CASE kind WHEN 'if-false' THEN '!(' ELSE '' END || '{E}.ifMatch(\"' || id || '\"))' || CASE kind WHEN 'if-false' THEN ')' ELSE '' END AS \"check\", "
    f"'DO {E}.register(\"' || id || '\", new {E}.Evaluator() {{' || chr(10) || '    public boolean eval() {{' || chr(10) || '        return !{E}.ifEq(k, ' || split_part(shown, ' != ', 2) || ');' || chr(10) || '    }}' || chr(10) || '}});' AS registration FROM i"
)
def registration_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What safe mode makes of conditions that have no simple form: a guard by id and a registered evaluator."""
    unlike = F.when(F.col("kind").isin("if-true", "if-false"), F.replace(F.col("condition_text"), F.lit("=="), F.lit("!="))).otherwise(F.col("condition_text"))
    events = scan_events(spark, sf_dir).where("language = 'kotlin'").withColumn("condition_text", unlike)
    made = rules.to_rules(events, rules.Style(safe_mode=True)).where("rule_kind in ('if-true', 'if-false')")
    return made.select(F.col("place.scan_seq").alias("scan_seq"), "check", "registration")


LEGACY = """l AS (SELECT *, 'com.example.U' || (event_id % 7) AS fqcn, 'm' || (event_id % 23) AS method, event_id % 400 + 1 AS line, json_extract_string(props, '$.k') AS k,
  CASE event_type WHEN 'view' THEN 'is-true' WHEN 'click' THEN 'is-false' WHEN 'signup' THEN 'when' WHEN 'purchase' THEN 'case' ELSE 'write-x' END AS rule_kind FROM events)"""


@query(
    f"WITH {LEGACY}, s AS (SELECT *, CASE rule_kind WHEN 'is-true' THEN 'k is T' || k WHEN 'is-false' THEN 'k is T' || k WHEN 'when' THEN CASE WHEN event_id % 2 = 0 THEN 'k' END WHEN 'case' THEN k ELSE 'x' END AS shown FROM l) "
    "SELECT event_id, concat_ws(chr(10), 'RULE ' || fqcn || '.' || method || ':' || line || ':' || rule_kind, 'CLASS ' || fqcn, 'METHOD ' || method || '(..)', 'HELPER trace.Helper', "
    "CASE rule_kind WHEN 'write-x' THEN 'AFTER WRITE $x' ELSE 'AT LINE ' || line END, CASE rule_kind WHEN 'is-true' THEN 'IF (' || shown || ')' WHEN 'is-false' THEN 'IF (!(' || shown || '))' END, "
    "'DO ' || CASE rule_kind WHEN 'when' THEN 'sw' WHEN 'case' THEN 'kase' WHEN 'write-x' THEN 'writeVar' ELSE 'iff' END || '(\"' || fqcn || '\",\"' || method || '\",' || line || ',\"' || coalesce(shown, 'when { … }') || '\"' "
    "|| CASE rule_kind WHEN 'is-true' THEN ', true)' WHEN 'is-false' THEN ', false)' WHEN 'write-x' THEN ', $x)' ELSE ')' END, 'ENDRULE') AS rule_text FROM s"
)
def legacy_rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules in the older mode's kinds, as its scanner gives them, and the text they get."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    made = F.when(kind == "view", "is-true").when(kind == "click", "is-false").when(kind == "signup", "when").when(kind == "purchase", "case").otherwise("write-x")
    shown = F.when(made.startswith("is-"), F.concat(F.lit("k is T"), k)).when(made == "when", F.when(F.col("event_id") % 2 == 0, "k")).when(made == "case", k).otherwise("x")
    rows = _table(spark, sf_dir, "events").select(
        F.when(made.startswith("is-"), "java").otherwise("kotlin").alias("language"),
        F.concat(F.lit("com.example.U"), F.col("event_id") % 7).alias("fqcn"),
        F.concat(F.lit("m"), F.col("event_id") % 23).alias("method"),
        made.alias("rule_kind"),
        (F.col("event_id") % 400 + 1).cast("int").alias("line"),
        shown.alias("condition_text"),
        F.lit("/src/F.kt").alias("path"),
        F.col("event_id").alias("idx"),
    )
    return rules.from_rows(rows, rules.Style(), 0).select(F.col("place.line").alias("event_id"), "rule_text")


@query(
    "SELECT o_orderkey, l_linenumber AS line, (o_orderkey % 7) IS NOT DISTINCT FROM n AS same_number, o_orderstatus IS NOT DISTINCT FROM l_linestatus AS same_text, n IS NULL AND o_orderstatus IS NULL AS mixed, "
    "(o_orderkey % 7) IS NOT DISTINCT FROM n AS whole_and_float, n IS NULL OR n % 2 = 0 AS tenths, n IS NULL OR n % 2 = 0 AS decimal_and_double "
    "FROM orders JOIN (SELECT *, CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber END AS n FROM lineitem) ON o_orderkey = l_orderkey"
)
def null_safe_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality of numbers of one and of different kinds, of texts, and of a number with a text; every third number is null."""
    n = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linenumber"))
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), n.alias("n"), "l_linestatus")
    both = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 7).alias("seven")).join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    # a tenth as a float is not the double nearest to it, yet both say 0.1; odd numbers are moved away
    tenth = F.col("n") / 10
    moved = F.when(F.col("n") % 2 == 0, tenth).otherwise(tenth + 0.5)
    kinds = {"seven_float": F.col("seven").cast("float"), "tenth_float": tenth.cast("float"), "moved": moved, "tenth_decimal": tenth.cast("decimal(9,3)")}
    both = both.withColumns(kinds)
    pick = lambda a, b: evaluate.if_eq(both, a, b)
    return both.select(
        "o_orderkey",
        "line",
        pick("seven", "n").alias("same_number"),
        pick("o_orderstatus", "l_linestatus").alias("same_text"),
        pick("n", "o_orderstatus").alias("mixed"),
        pick("seven_float", "n").alias("whole_and_float"),
        pick("tenth_float", "moved").alias("tenths"),
        pick("tenth_decimal", "moved").alias("decimal_and_double"),
    )


@query(
    "WITH g AS (SELECT doc_id::VARCHAR AS rule_id, arg_max(CASE WHEN toxic = 1 THEN 'throws' WHEN quality = 1 THEN 'true' ELSE 'false' END, doc_id) AS outcome FROM labels GROUP BY doc_id) "
    "SELECT d.doc_id::VARCHAR AS rule_id, coalesce(outcome <> 'false', true) AS matched FROM documents d LEFT JOIN g ON g.rule_id = d.doc_id::VARCHAR"
)
def fail_open_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = F.when(F.col("toxic") == 1, "throws").when(F.col("quality") == 1, "true").otherwise("false")
    registered = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("rule_id"), outcome.alias("outcome"))
    wanted = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("rule_id"))
    return evaluate.if_match(wanted, registered)


TYPES = "e AS (SELECT n_name AS type, r_name AS supertype FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'WORLD' FROM region)"


def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = _table(spark, sf_dir, "region")
    nations = _table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select(F.col("n_name").alias("type"), F.col("r_name").alias("supertype")).union(regions.select("r_name", F.lit("WORLD")))


@query(f"WITH RECURSIVE {TYPES}, c AS (SELECT type, type AS ancestor FROM e UNION SELECT 'WORLD', 'WORLD' UNION SELECT c.type, e.supertype FROM c JOIN e ON c.ancestor = e.type) SELECT type, ancestor FROM c")
def type_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.type_closure(_types(spark, sf_dir))


@query(f"WITH {TYPES} SELECT n_name AS type, EXISTS (SELECT 1 FROM e WHERE e.type = n_name AND e.supertype = 'ASIA') OR n_name = 'ASIA' AS is_instance FROM nation")
def instance_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("type"))
    return evaluate.if_instance_of(values, evaluate.type_closure(_types(spark, sf_dir)), "ASIA")


# --- traces -----------------------------------------------------------------------------------------


def trace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as parsed trace lines."""
    phase = F.when(F.col("event_type").isin("view", "signup"), "enter").when(F.col("event_type") == "error", "failed").otherwise("exit")
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("cid"), F.concat(F.lit("m"), F.col("event_id") % 5).alias("method"), phase.alias("phase"), F.col("ts").cast("timestamp").alias("ts"), F.floor("value").cast("bigint").alias("elapsed_ms"))


TRACE = "t AS (SELECT event_id AS seq, user_id AS cid, 'm' || (event_id % 5) AS method, CASE WHEN event_type IN ('view', 'signup') THEN 'enter' WHEN event_type = 'error' THEN 'failed' ELSE 'exit' END AS phase, ts, floor(value)::BIGINT AS elapsed_ms FROM events)"


@query(
    f"WITH {TRACE}, d AS (SELECT *, sum(CASE WHEN phase = 'enter' THEN 1 ELSE -1 END) OVER (PARTITION BY cid ORDER BY seq) AS run FROM t), "
    "p AS (SELECT *, CASE WHEN phase = 'enter' THEN run ELSE run + 1 END AS depth FROM d), "
    "n AS (SELECT *, lead(seq) OVER (PARTITION BY cid, depth ORDER BY seq) AS exit_seq, lead(phase) OVER (PARTITION BY cid, depth ORDER BY seq) AS ended FROM p) "
    "SELECT cid, depth::BIGINT AS depth, method, seq AS enter_seq, coalesce(exit_seq, -1) AS exit_seq, ended AS phase FROM n WHERE phase = 'enter'"
)
def trace_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.pair_by_depth(trace_lines(spark, sf_dir)).select("cid", F.col("depth").cast("bigint").alias("depth"), "method", "enter_seq", _filled("exit_seq"), "phase")


@query(
    f"WITH RECURSIVE {TRACE}, n AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY seq) AS k FROM t), "
    "s AS (SELECT DISTINCT cid, 0::BIGINT AS k, []::STRUCT(seq BIGINT, method VARCHAR)[] AS before, NULL::BIGINT AS seq, NULL::VARCHAR AS phase, 0::BIGINT AS place, []::STRUCT(seq BIGINT, method VARCHAR)[] AS stack FROM n "
    "UNION ALL SELECT cid, k, stack, seq, phase, place, CASE WHEN phase = 'enter' THEN list_append(stack, {'seq': seq, 'method': method}) WHEN place > 0 THEN stack[1:place - 1] ELSE stack END FROM "
    "(SELECT n.cid, n.k, s.stack, n.seq, n.phase, n.method, coalesce(list_max(list_filter(range(1, len(s.stack) + 1), lambda i: s.stack[i].method = n.method)), 0)::BIGINT AS place FROM s JOIN n ON n.cid = s.cid AND n.k = s.k + 1)), "
    "x AS (SELECT cid, before[place].seq AS enter_seq, seq AS exit_seq, phase FROM s WHERE phase <> 'enter' AND place > 0) "
    "SELECT s.cid, len(s.stack)::BIGINT AS depth, s.stack[-1].method AS method, s.seq AS enter_seq, coalesce(x.exit_seq, -1) AS exit_seq, x.phase FROM s LEFT JOIN x ON x.cid = s.cid AND x.enter_seq = s.seq WHERE s.phase = 'enter'"
)
def trace_pairing_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a trace in which many lines have no partner."""
    return trace.pair_calls(trace_lines(spark, sf_dir)).select("cid", "depth", "method", "enter_seq", _filled("exit_seq"), "phase")


def _stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


@query(
    f"WITH {TRACE}, g AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY cid ORDER BY ts) > INTERVAL 30 MINUTE, true)::INT AS fresh FROM t), "
    "s AS (SELECT *, sum(fresh) OVER (PARTITION BY cid ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) "
    "SELECT cid, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%g') AS \"start\", strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%g') AS \"end\", count(*) AS lines FROM s GROUP BY cid, k"
)
def trace_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.sessions(trace_lines(spark, sf_dir)).select("cid", _stamp("start").alias("start"), _stamp("end").alias("end"), "lines")


@query(f"WITH {TRACE} SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S.%g') AS \"start\", method, phase, count(*) AS calls, sum(elapsed_ms)::BIGINT AS total_ms FROM t GROUP BY ALL")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.outcome_counts(trace_lines(spark, sf_dir), "1 day").withColumn("start", _stamp("start"))


@query(
    "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'INFO' END AS level, CASE event_type WHEN 'view' THEN 'enter' WHEN 'error' THEN 'failed' ELSE 'exit' END AS phase, "
    "CASE WHEN event_type = 'purchase' THEN 'u' || user_id WHEN user_id % 4 > 0 THEN user_id::VARCHAR END AS cid, 'U' || (user_id % 9) || '.run(int, String)' AS method, "
    "CASE event_type WHEN 'view' THEN '[' || event_id || ', [x]]' END AS args, CASE WHEN event_type IN ('click', 'signup') THEN 'got ' || event_id END AS result, CASE event_type WHEN 'error' THEN 'java.lang.IllegalStateException' END AS exception, "
    "CASE event_type WHEN 'error' THEN 'no: ' || event_id END AS message, CASE event_type WHEN 'view' THEN 'F.kt:' || (event_id % 90) END AS source, CASE event_type WHEN 'purchase' THEN event_id % 1000 ELSE -1 END AS elapsed_ms FROM events"
)
def trace_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CALL, RET and THROW messages without a head, and console lines; every fourth id is the one that stands for none."""
    kind, method, n = F.col("event_type"), F.concat(F.lit("U"), F.col("user_id") % 9, F.lit(".run(int, String)")), F.col("event_id").cast("string")
    cid = F.when(F.col("user_id") % 4 > 0, F.col("user_id").cast("string")).otherwise("-")
    said = F.concat(F.lit("cid="), cid, F.lit(" method="), method)
    line = (
        F.when(kind == "view", F.concat(F.lit("CALL "), said, F.lit(" args=["), n, F.lit(", [x]] at=F.kt:"), F.col("event_id") % 90))
        .when(kind == "error", F.concat(F.lit("THROW "), said, F.lit(" ex=java.lang.IllegalStateException msg=no: "), n))
        .when(kind == "purchase", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" INFO  [u"), "user_id", F.lit("] trace.Log - RET  cid= method="), method, F.lit(" result=")))
        .otherwise(F.concat(F.lit("RET  "), said, F.lit(" result=got "), n))
    )
    ok = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" INFO  [u"), "user_id", F.lit("] trace.Log - ← U"), F.col("user_id") % 9, F.lit(".run(int,String) OK in "), F.col("event_id") % 1000, F.lit(" ms"))
    lines = _table(spark, sf_dir, "events").select("event_id", F.when(kind == "purchase", ok).otherwise(line).alias("value"))
    found = trace.parse(lines, ["event_id"]).withColumn("method", F.replace("method", F.lit("int,String"), F.lit("int, String")))
    return found.select("event_id", "level", "phase", "cid", "method", "args", "result", "exception", "message", "source", _filled("elapsed_ms"))


@query(
    "SELECT event_id, CASE WHEN event_type = 'view' THEN 'enter' WHEN event_type = 'error' THEN 'failed' ELSE 'exit' END AS phase, CASE WHEN user_id % 4 > 0 THEN user_id::VARCHAR END AS cid, 'U' || (user_id % 9) || '.run(..)' AS method, "
    "CASE WHEN event_type = 'view' THEN '[' || event_id || ', x]' END AS args, CASE WHEN event_type <> 'view' THEN event_id % 1000 ELSE -1 END AS elapsed_ms, CASE WHEN event_type = 'error' THEN 'bad value' END AS message FROM events"
)
def trace_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, method = F.col("event_type"), F.concat(F.lit("U"), F.col("user_id") % 9, F.lit(".run(..)"))
    ms = F.concat((F.col("event_id") % 1000).cast("string"), F.lit(" ms"))
    body = (
        F.when(kind == "view", F.concat(F.lit("→ "), method, F.lit(" ["), "event_id", F.lit(", x]")))
        .when(kind == "error", F.concat(F.lit("✖ "), method, F.lit(" failed in "), ms, F.lit(": bad value (see stacktrace in console)")))
        .otherwise(F.concat(F.lit("← "), method, F.lit(" OK in "), ms))
    )
    cid = F.when(F.col("user_id") % 4 > 0, F.col("user_id").cast("string")).otherwise("-")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" [WARN] [cid="), cid, F.lit("] "), body)
    lines = _table(spark, sf_dir, "events").select("event_id", line.alias("value"))
    return trace.parse(lines, ["event_id"]).select("event_id", "phase", "cid", "method", "args", _filled("elapsed_ms"), "message")
