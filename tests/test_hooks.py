import pytest

from callweave import fixtures
from callweave.functions.evaluators import Registry
from callweave.functions.predicates import Predicate
from callweave.operators import events as ev
from callweave.operators import rules
from callweave.plans import diagnostics
from callweave.sources import udtf
from callweave.streaming import sink


def test_scanners_in_sql(spark):
    udtf.register(spark)
    spark.createDataFrame([*fixtures.SOURCES, ("kotlin", "/x.kt", None)], "language string, path string, text string").createOrReplaceTempView("sources")
    got = spark.sql("SELECT e.kind, e.line FROM sources s, LATERAL scan_kotlin(s.text, element_at(split(s.path, '/'), -1)) e WHERE s.language = 'kotlin'").collect()
    assert [tuple(r) for r in got][:3] == [("if-true", 5), ("if-false", 5), ("write", 7)]
    assert spark.sql("SELECT e.* FROM sources s, LATERAL scan_java(s.text, '') e WHERE s.language = 'java'").count() == 8
    assert spark.sql("SELECT e.* FROM sources s, LATERAL regex_java_rules(s.text, '') e WHERE s.language = 'java'").count() == 15
    assert spark.sql("SELECT e.* FROM sources s, LATERAL legacy_kotlin_rules(s.text, 'a.kt') e WHERE s.language = 'kotlin'").count() == 7


def test_registry_hook(spark):
    r = Registry()
    r.register("a", lambda row: row["n"] > 1)
    r.register("bad", lambda row: 1 / 0)
    r.register(None, lambda row: False)
    r.register("a", None)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("bad", 1), ("none", 1), (None, 1)], "id string, n int")
    assert [x[0] for x in df.select(r.matched(df, "id", ["n"])).collect()] == [False, True, True, True, True]
    r.register("a", lambda row: False)
    assert r.if_match("a") is False
    r.reset()
    assert r.if_match("a") is True and r.if_match(None) is True


def test_own_classifier(spark):
    events = spark.createDataFrame([("kotlin", "C", "m", "m()", "if-true", 3, "a == 1", 0)], ev.EVENT_SCHEMA + ", scan_seq bigint")
    style = rules.Style(entry_exit=False, classify=lambda text: Predicate("original", (f"mine({text})",)))
    assert rules.to_rules(events, style).first()["check"] == "IF (mine(a == 1))"


@pytest.mark.parametrize("name,level", [("debug", 10), (" Trace ", 5), (None, 40), ("loud", 40), ("WARN", 30)])
def test_levels(name, level):
    assert diagnostics.level_of(name) == level


def test_log_file_never_fails(tmp_path):
    log = diagnostics.logger("INFO", str(tmp_path / "a/b.log"))
    log.info("said")
    log.debug("not said")
    assert (tmp_path / "a/b.log").read_text().endswith("[INFO] said\n")
    diagnostics.logger("INFO", "/proc/none/x.log").info("lost")


def test_stream_of_rules_into_shards(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = spark.createDataFrame([("kotlin", "C", f"m{k}", "m()", "if-true", k, "a == 1", k) for k in range(20)], ev.EVENT_SCHEMA + ", scan_seq bigint")
    made = rules.to_rules(events).select("shard_key", "rule_text")
    for n in (1, 2):
        made.where(f"shard_key like 'C#m{n}%'").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(made.schema).parquet(f"{tmp_path}/in")
        assert sink.start(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "# head\n", 2).awaitTermination(60)
    found = {p.name: p.read_text() for p in (tmp_path / "out").iterdir() if p.name.endswith(".btm")}
    assert {n.rpartition("-")[2] for n in found} == {"00001.btm", "00002.btm"}
    assert all(t.startswith("# head\nRULE") for t in found.values())
    assert sum(t.count("ENDRULE") for t in found.values()) == made.where("shard_key like 'C#m1%' or shard_key like 'C#m2%'").count()
