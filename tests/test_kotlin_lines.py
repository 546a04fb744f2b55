"""Kotlin events over a table against those of one file at a time."""

import random

from callweave import fixtures, generated
from callweave.sources import kotlin, kotlin_lines

PIECES = [
    "class A {", "  object B { }", "open class C(val x: Int) {", "fun f(a: Int, b: Map<String, Int>, c) {", "  private fun g() = 1", "suspend fun h(x: T): R {", "}", "}", "  }", "if (a == b) x = 1", "if (a &&", "   b(c)) {", ") y = (2", "when (k", "  .trim( )) {",
    "when {", "  1, 2 -> go()", "else -> { z = 3 }", "return", "throw  E( \"x\" ) // why", "// if (no) {", "val q = w; r += 1; s == t; u <= v", "{ if ( ) if (one) if (two [ 3 ] , 4) }", "", "x->y", "-> z", "returned = unthrow", "}}", "{{", "\tif\t(\ta\t)",
]


def rows(frame):
    return sorted((r["path"], r["idx"], *(r[c] for c in kotlin_lines.FIELDS)) for r in frame.collect())


def plain(sources):
    return sorted((p, k, *e) for p, t in sources for k, e in enumerate(kotlin.scan(t, p.rsplit("/", 1)[-1])))


def key(rows_):
    return [tuple((x is None, x) for x in r) for r in rows_]


def test_random_files_give_the_same_events(spark):
    r = random.Random(7)
    sources = [(f"/s/F{k}.x.kt", r.choice(["", "package a.b\n", "  package a.c.d  \r\n"]) + r.choice(["\n", "\r\n"]).join(r.choice(PIECES) for _ in range(r.randint(0, 60))) + r.choice(["", "\n"])) for k in range(150)]
    sources += [("/s/Approval.kt", fixtures.KOTLIN), ("/s/empty.kt", ""), *(("/s/" + n + ".kt", "package p\nclass U {\n" + t + generated.END["kotlin"]) for n, t in generated.KOTLIN.items())]
    frame = spark.createDataFrame(sources, "path string, text string")
    got, want = (sorted(x, key=lambda r: r[:2]) for x in ([(x["path"], x["idx"], *(x[c] for c in kotlin_lines.FIELDS)) for x in kotlin_lines.events(frame).collect()], [(p, k, *e) for p, t in sources for k, e in enumerate(kotlin.scan(t, p.rsplit("/", 1)[-1]))]))
    assert len(want) > 500
    for a, b in zip(got, want):
        assert a == b, (a, b, dict(sources)[b[0]])
    assert got == want


def test_packages_and_plan(spark):
    frame = spark.createDataFrame([("/a.kt", "package a.b\n" + fixtures.KOTLIN.split("\n", 1)[1]), ("/b.kt", "package b\n" + fixtures.KOTLIN.split("\n", 1)[1])], "path string, text string")
    assert {r["path"] for r in kotlin_lines.events(frame, include=["a", "c"]).collect()} == {"/a.kt"}
    assert {r["path"] for r in kotlin_lines.events(frame, exclude=["a.b"]).collect()} == {"/b.kt"}
    plan = kotlin_lines.events(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_events_without_their_number_need_no_shuffle(spark):
    frame = spark.createDataFrame([("/a.kt", fixtures.KOTLIN)], "path string, text string")
    plan = kotlin_lines.events(frame).drop("idx")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_conditions_end_anywhere_after_their_function(spark):
    text = "fun a() {\n  if (b(\n}\nclass C {\n  )) x\n  fun d() = when (e)\n}\n"
    got = sorted((x["idx"], *(x[c] for c in kotlin_lines.FIELDS)) for x in kotlin_lines.events(spark.createDataFrame([("/s/A.kt", text)], "path string, text string")).collect())
    assert got == [(k, *e) for k, e in enumerate(kotlin.scan(text, "A.kt"))] and "b(}class C {)" in {e[-1] for e in got}


def test_java_files_of_other_packages_are_not_read_whole(monkeypatch):
    from callweave.sources import java

    text = "// package no;\npackage a . b;\nclass C { int m() { return 1; } }"
    assert [e[1] for e in java.scan(text, "C.java", ["a.b"])] == ["a.b.C"]
    monkeypatch.setattr(java, "Source", None)
    assert list(java.scan(text, "C.java", ["a.c"])) == []
