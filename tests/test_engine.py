import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from callweave import fixtures
from callweave.operators import dispatch, rules
from callweave.operators import events as ev
from callweave.plans import sink
from callweave.plans.config import Config
from callweave.plans.engine import Engine

EVENTS = ev.EVENT_SCHEMA + ", scan_seq bigint"


@pytest.fixture()
def project(tmp_path):
    for name, text in (("kotlin/Approval.kt", fixtures.KOTLIN), ("java/Mode.java", fixtures.JAVA)):
        p = tmp_path / "src/main" / name
        p.parent.mkdir(parents=True)
        p.write_text(text)
    return tmp_path


def config(project, **options):
    return Config(**{"project_dir": str(project), "shards": 3, **options})


def texts(engine):
    return [r["rule_text"] for r in engine.rules().orderBy("place").select("rule_text").collect()]


def test_rules_of_a_project(spark, project):
    found = texts(Engine(spark, config(project)))
    assert found[0] == 'RULE enter@com.example.flow.Mode.pick\nCLASS com.example.flow.Mode\nMETHOD pick(..)\nHELPER trace.Helper\nAT ENTRY\nDO enter("com.example.flow.Mode","pick", $LINE)\nENDRULE'
    assert any('IF (!(amount > 0 && amount < 10))\nDO iff("com.example.flow.Approval","decide",5,"amount > 0 && amount < 10", false)' in t for t in found)
    assert any("AFTER WRITE $approved" in t for t in found) and any('DO sw("com.example.flow.Approval","decide",11,"name.trim().lowercase()")' in t for t in found)
    assert sum("RULE enter@com.example.flow.Mode.run" in t for t in found) == 1
    # pseudo-methods that only the patterns see get rules from them
    assert any(t.startswith("RULE enter@com.example.flow.Mode.switch") for t in found)


def test_runs_report_to_their_log_file(spark, project, tmp_path):
    log = tmp_path / "log/run.log"
    with Engine(spark, config(project, log_level="info", log_file=str(log))) as engine:
        names = engine.write(f"file://{tmp_path}/out")
    assert f"wrote {len(names)} files" in log.read_text() and "[INFO]" in log.read_text()


def test_options_choose_rules(spark, project):
    everything = texts(Engine(spark, config(project)))
    assert not any("enter@" in t for t in texts(Engine(spark, config(project, entry_exit=False))))
    assert not any("Mode" in t for t in texts(Engine(spark, config(project, include_java=False))))
    # a prefix of classes selects nothing, for it is asked of the package first
    assert Engine(spark, config(project, pkg_prefixes=("com.example.flow.App",))).events().count() == 0
    assert texts(Engine(spark, config(project, pkg_prefixes=("com.example",)))) == everything
    assert texts(Engine(spark, config(project, exclude_patterns=("**.java", "*.kt")))) == []
    cut = texts(Engine(spark, config(project, max_string_length=6)))
    assert any('"amount…"' in t and "IF (amount > 0 && amount < 10)" in t for t in cut)
    # without entry and exit no method counts as seen, so the patterns give its branches again, unless strict
    again = lambda **o: sum(":5:if-true" in t and "Mode.pick" in t for t in texts(Engine(spark, config(project, entry_exit=False, **o))))
    assert again() == 2 and again(strict=True) == 1


def test_safe_mode_registers_evaluators(spark):
    e = "org.example.trace.SafeEval"
    events = spark.createDataFrame([("kotlin", "C", "m", "m()", "if-true", 3, "value != null", 0), ("kotlin", "C", "m", "m()", "if-true", 4, "value != null && f(x)", 1), ("kotlin", "C", "m", "m()", "if-false", 5, "a == 1", 2), ("java", "J", "m", "m()", "if-true", 3, "f(x)", 3)], EVENTS)
    found = {r["rule_name"]: r for r in rules.to_rules(events, rules.Style(safe_mode=True, entry_exit=False)).collect()}
    first = found["C.m:3:if-true"]
    assert f"IF ({e}.ifMatch(" in first["rule_text"] and f"        return !{e}.ifEq(value, null);\n    }}\n}});\nDO iff(" in first["rule_text"]
    assert "        return true;" in found["C.m:4:if-true"]["registration"]
    assert found["C.m:5:if-false"]["check"] == "IF (!(a == 1))" and found["C.m:5:if-false"]["registration"] is None
    assert found["J.m:3:if-true"]["check"] == "IF (f(x))"
    forced = {r["rule_name"]: r["check"] for r in rules.to_rules(events, rules.Style(safe_mode=True, force_helper=True, entry_exit=False)).collect()}
    assert forced["C.m:5:if-false"] == f"IF (!({e}.ifEq(a, 1)))"


def test_synthetic_switch_comes_before_every_orphan_branch(spark):
    rows = [("kotlin", "C", "m", "m()", "when-branch", 3, "x"), ("kotlin", "C", "m", "m()", "when-branch", 4, "y"), ("kotlin", "C", "m", "m(Int)", "switch", 5, None), ("kotlin", "C", "m", "m(Int)", "when-branch", 6, "z"), ("kotlin", "C", "m", "m()", "return", 7, None)]
    made = rules.to_rules(spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], EVENTS)).orderBy("place").select("rule_kind", "line").collect()
    assert [tuple(r) for r in made] == [("enter", None), ("exit", None), ("when", 3), ("case", 3), ("when", 4), ("case", 4), ("enter", None), ("exit", None), ("when", 5), ("case", 6)]


def test_minimum_branches_and_the_keyless_group(spark):
    rows = [("kotlin", "a.C", "m", "m()", "if-true", 1, "p"), ("kotlin", "a.C", "m", "m()", "if-false", 1, "p"), ("kotlin", "b.D", "n", "n()", "if-true", 1, "p")]
    made = rules.to_rules(spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], EVENTS))
    names = lambda df: sorted(r["rule_name"] for r in df.collect())
    assert names(dispatch.selected(made, (), 2)) == ["a.C.m:1:if-false", "a.C.m:1:if-true", "enter@a.C.m", "enter@b.D.n", "exit@a.C.m", "exit@b.D.n"]
    assert "enter@b.D.n" in names(dispatch.selected(made, ["a"], 1)) and "enter@b.D.n" not in names(dispatch.selected(made, ["a"], 1, strict=True))
    assert not any("@" in n for n in names(dispatch.selected(made, ["b"], 1))) and names(dispatch.selected(made, ["b"], 0)) == ["b.D.n:1:if-true", "enter@b.D.n", "exit@b.D.n"]


def test_rotation_is_a_greedy_fold(spark):
    sizes = [10, 30, 20, 45, 5, 5, 5, 60, 1] * 20
    df = spark.createDataFrame([(0, k, k, "x" * (n - 2) if n > 2 else "") for k, n in enumerate(sizes)], "shard int, turn int, place int, rule_text string")
    got = [(r["rotation"], r["bytes"]) for r in dispatch.rotated(df, 8, 64, 1).orderBy("seq").collect()]
    want, rotation, held = [], 1, 8
    for n in (max(2, x) for x in sizes):
        if held + n > 64:
            rotation, held = rotation + 1, 8
        held += n
        want.append((rotation, n))
    assert got == want
    assert {r["rotation"] for r in dispatch.rotated(df, 8, 0, 1).collect()} == {0}


@pytest.mark.parametrize("gz", [False, True])
def test_written_files(spark, project, gz):
    engine = Engine(spark, config(project, gzip_output=gz, rotate_max_bytes_per_file=1500, shards=2, pkg_prefixes=("com",), tracked_vars=("approved",)))
    out = project / "out"
    names = engine.write(str(out))
    assert names == sorted(p.name for p in out.iterdir() if not p.name.startswith(".")) and all(n.endswith(".btm.gz" if gz else ".btm") for n in names)
    assert names[0] == f"tracing-0001-00001.btm{'.gz' if gz else ''}" and len(names) > 2
    read = {n: (gzip.decompress((out / n).read_bytes()) if gz else (out / n).read_bytes()).decode() for n in names}
    head = "# Generated by callweave\n# Helper: trace.Helper\n\n# Package prefix filters: com\n# Tracked variables: approved\n"
    assert all(t.startswith(head) and t.endswith("ENDRULE\n\n") for t in read.values())
    assert sum(t.count("ENDRULE") for t in read.values()) == engine.rules().count()
    assert {r["file"]: r["content"] for r in sink.contents(engine.files()).collect()} == read
    assert engine.write(str(out)) == names and {n: (out / n).read_bytes() for n in names}.keys() == read.keys()


def test_nothing_to_write_still_gives_files(spark, tmp_path):
    names = Engine(spark, Config(project_dir=str(tmp_path), shards=2, rotate_max_bytes_per_file=0)).write(str(tmp_path / "out"))
    assert names == ["tracing-0001.btm", "tracing-0002.btm"]
    assert Path(tmp_path / "out" / names[0]).read_text() == "# Generated by callweave\n# Helper: trace.Helper\n\n# No matching sources were found.\n"


def test_same_rules_under_any_partitioning(spark, project):
    (project / "src/main/java/Big.java").write_text("class Big { void m() {\n" + "\n".join(f"if (a == {k}) {{ x(); }}" for k in range(2000)) + "\n} }\n")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", "2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append({r["file"]: r["content"] for r in sink.contents(Engine(spark, config(project, shards=4)).files()).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and sum(t.count(":if-true\n") for t in seen[0].values()) == 2002


def test_legacy_mode(spark, project):
    engine = Engine(spark, config(project, use_ast_scanner=False, tracked_vars=("approved",)))
    found = texts(engine)
    assert any("write-approved" in t for t in found) and any("Mode.pick:5:if-true" in t for t in found)
    assert engine.header().startswith("# Generated by callweave\n# Helper: trace.Helper\n# Tracked")
    modern, legacy = (sum("Approval" in t for t in x) for x in (texts(Engine(spark, config(project))), found))
    assert abs(modern - legacy) <= 5


def test_failures_are_reported_not_hidden(spark, project, monkeypatch):
    from callweave.sources import java

    def broken(text, name):
        raise ValueError("no")
        yield

    engine = Engine(spark, config(project))
    monkeypatch.setattr(java, "scan", broken)
    assert [r["error"] for r in engine.failures().collect()] == ["ValueError: no"]


def test_brace_depth(spark):
    lines = spark.createDataFrame([("p", 1, "a {"), ("p", 2, "{ } }"), ("q", 1, "}")], "path string, n int, line string")
    assert [r["depth"] for r in ev.brace_depth(lines).orderBy("path", "n").collect()] == [1, 0, -1]


def test_prefixes_and_packages(spark):
    assert ev.merged_prefixes(["a", " ", "a"], "b") == ["a", "a", "b"] and ev.merged_prefixes([], " ") == []
    df = spark.createDataFrame([("a.b",), ("a.c",), (None,)], "package string")
    assert [r[0] for r in ev.by_package(df, ["a"], ["a.c"]).collect()] == ["a.b"] and ev.by_package(df, []).count() == 3
    assert df.where(F.col("package").isNull()).count() == 1
