import pytest

from callweave import fixtures, generated
from callweave.sources import files, java, kotlin, kotlin_tree


def kinds(text, name="F.kt", scan=kotlin.scan):
    return [(e[4], e[5], e[6]) for e in scan(text, name)]


def test_kotlin_events_of_the_fixture():
    found = list(kotlin.scan(fixtures.KOTLIN, "Approval.kt"))
    assert [(e[4], e[6]) for e in found][:3] == [("if-true", "amount > 0 && amount < 10"), ("if-false", "amount > 0 && amount < 10"), ("write", "approved")]
    assert {e[1] for e in found} == {"com.example.flow.Approval"} and found[0][3] == "decide(Int,String)"


def test_kotlin_top_level_functions_and_packages():
    text = "package a.b\nfun f(x) {\n  when {\n    x > 1 -> return\n  }\n}\n"
    found = list(kotlin.scan(text, "my.file.kt"))
    assert found[0][:5] == ("kotlin", "a.b.my.fileKt", "f", "f(Any)", "switch") and found[0][6] is None
    assert list(kotlin.scan(text, "x.kt", ["a.c"])) == [] and list(kotlin.scan(text, "x.kt", ["a"], ["a.b"])) == []
    assert list(kotlin.scan(text.replace("package a.b", ""), "x.kt"))[0][1] == "xKt"


def test_kotlin_compatible_quirks():
    body = "fun f() {\n%s\n}\n"
    assert kinds(body % "val x: Int = 5") == [("write", 2, "Int")]
    assert kinds(body % "list.map { it -> it }")[0][0] == "when-branch"
    assert kinds(body % "if (a == b // c\n) {}") == [("if-true", 2, "a == b"), ("if-false", 2, "a == b")]
    assert kinds(body % "if (a(b, c ) . d [ 1 ]) x") == [("if-true", 2, "a(b, c). d [1]"), ("if-false", 2, "a(b, c). d [1]")]
    assert kinds(body % "if (open") == []
    swallowing = "fun f() = 1\nfun g() {\n return 2\n}\n"
    assert {e[2] for e in kotlin.scan(swallowing, "x.kt")} == {"f"}


def test_long_heads_hide_nothing():
    many = ", ".join(f"T{k}" for k in range(60))
    text = f"package a\nfun f() {{ if (x) y }}\nfun <{many}> g(a: T1) {{ if (p) q }}\nfun interface I {{ fun m(): Int }}\nfun List<Map<String, Int>>.h() {{ if (r) s }}\nval broken = fun"
    found = [(r[1], r[2], r[4]) for r in kotlin_tree.legacy_rules(text, "F.kt", entry_exit=False)]
    assert found == [(m, k, c) for m, c in (("f", "x"), ("g", "p"), ("h", "r")) for k in ("if-true", "if-false")]
    values = ", ".join(f'"v{k}"' for k in range(300))
    assert {e[1] for e in java.scan(f"@Tags({{{values}}})\npackage p.q;\nclass C {{ int f(int x) {{ if (x > 1) return 1; return 0; }} }}")} == {"p.q.C"}


@pytest.mark.parametrize("parameters,want", [("", "f()"), ("a: Int, b", "f(Int,Any)"), ("a: Map<K, V>", "f(Map<K,Any)"), ("a: List<String> ", "f(List<String>)")])
def test_kotlin_signatures(parameters, want):
    assert kotlin.signature("f", parameters) == want


def test_java_events_of_the_fixture():
    found = [(e[2], e[4], e[6]) for e in java.scan(fixtures.JAVA)]
    assert ("pick", "if-true", "mode > 1") in found and ("pick", "throw", 'new IllegalStateException("no")') in found
    assert [x for x in found if x[0] == "run"] == [("run", "switch", "k"), ("run", "switch-case", 'case "a"'), ("run", "switch-case", "default"), ("run", "return", None)]


def test_java_else_if_chains_repeat():
    text = "class C { void m() { if (a) {} else if (b) {} else if (c) {} } }"
    assert [e[6] for e in java.scan(text) if e[4] == "if-true"] == ["a", "b", "c", "b", "c", "c"]
    assert [e[6] for e in java.scan(text) if e[4] == "if-false"] == ["a", "b", "b"]


def test_java_long_chains_and_deep_blocks():
    chain = "class C { void m() { " + " else ".join(f"if (a == {k}) {{ f(); }}" for k in range(300)) + " } }"
    found = [e for e in java.scan(chain) if e[4] == "if-true"]
    assert len(found) == 300 * 301 // 2
    assert [e[6] for e in java.scan("class C { void m() { if (a) if (b) c(); else d(); else e(); return; } }") if e[4] == "if-false"] == ["a", "b"]


def test_java_nesting_constructors_lambdas_and_switch_expressions():
    text = """package p; class Outer { Outer() { if (x) y(); } Runnable r = () -> { if (q) z(); };
      class Inner { int m(int[] a, Map<String, List<Integer>> b) { return switch (a[0]) { case 1, 2 -> 3; default -> { yield 4; } }; } }
      interface I { default void d() { throw e; } void none(); } enum E { A, B { void k() { if (t) {} } }; void v() { while (u) if (w) break; } }
      record R(int n) { int twice() { return n * 2; } } void anon() { new Thread() { public void run() { if (deep) {} } }.start(); } }"""
    found = [(e[1], e[3], e[4], e[6]) for e in java.scan(text)]
    assert ("p.Outer$Inner", "m(int[], Map<String, List<Integer>>)", "switch-case", "case 1 | 2") in found
    assert not any(k == "switch" for _, _, k, _ in found) and not any(c in ("x", "q") for *_, c in found)
    assert ("p.Outer$I", "d()", "throw", "e") in found and ("p.Outer$E", "k()", "if-true", "t") in found and ("p.Outer$E", "v()", "if-true", "w") in found
    assert ("p.Outer$R", "twice()", "return", None) in found
    assert [x[1] for x in found if x[3] == "deep"] == ["anon()", "run()"]


def test_java_ignores_comments_strings_and_broken_text():
    assert list(java.scan('class C { void m() { // if (a)\n /* switch (b) {} */ String s = "if (c)"; } }')) == []
    assert list(java.scan("class C { void m( { if (")) == [] and list(java.scan("")) == []


def test_masking_keeps_length_and_lines():
    text = 'a "if (x)\\"y" \'c\' /* l1\nl2 */ b // c\nd'
    masked = java.mask(text)
    assert len(masked) == len(text) and masked.count("\n") == text.count("\n") and "if" not in masked and masked.endswith("\nd")


def test_regex_rules_nested_annotated_and_prefix():
    text = 'package p.q;\n@A("x")\npublic class Top {\n  @B\n  public void go(int n) {\n    if (n > 0) { }\n  }\n  static class In {\n    void deep() {\n    }\n  }\n}\n'
    found = [(r[0], r[1], r[2]) for r in java.regex_rules(text)]
    assert ("p.q.Top", "go", "enter") in found and ("p.q.Top", "go", "if-false") in found and ("p.q.In", "deep", "exit") in found
    assert list(java.regex_rules(text, "other")) == [] and list(java.regex_rules(text, "p"))
    assert java.declared_methods(text) >= {("p.q.Top", "go"), ("p.q.Top", "deep")}


def test_legacy_kotlin():
    text = """package p
class A { companion object { fun make(): A { return A() } }
  fun f(o: Any): Int {
    if (o is String && flag) { status = 1 }
    val status2 = 2
    fun local() { if (hidden) {} }
    return when (o) { is Int -> 1
      1, 2 -> 3
      else -> 4 } } }
fun ext(x: Int) = if (x > 1) 2 else 3
fun last() {}
"""
    rows = list(kotlin_tree.legacy_rules(text, "my.kt", tracked={"status", "status2"}))
    by = {(r[0], r[1]) for r in rows}
    assert by == {("p.A$Companion", "make"), ("p.A", "f"), ("p.myKt", "ext"), ("p.myKt", "last")}
    f = [(r[2], r[4]) for r in rows if r[1] == "f"]
    assert ("if-true", "o is String && flag") in f and ("is-true", "o is String") in f and ("write-status", "status") in f
    assert [t for k, t in f if k == "case"] == ["is Int", "1 | 2", "else"] and not any(k == "write-status2" for k, _ in f)
    assert list(kotlin_tree.legacy_rules(text, "my.kt", prefix="q")) == []


@pytest.mark.parametrize(
    "glob,path,want",
    [("**/*.java", "A.java", False), ("**/*.java", "a/A.java", True), ("**.java", "A.java", True), ("*.kt", "a/b.kt", False), ("a?.kt", "ab.kt", True), ("a?b", "a/b", False), ("{a,b}/*.kt", "b/x.kt", True), ("[ab].kt", "a.kt", True), ("[!ab].kt", "a.kt", False), ("a+b.kt", "a+b.kt", True)],
)
def test_path_globs(spark, glob, path, want):
    df = spark.createDataFrame([(path,)], "rel_path string")
    assert (files.by_globs(df, [glob]).count() == 1) is want
    assert (files.by_globs(df, [], [glob]).count() == 0) is want


def test_loose_globs():
    assert files.loose_glob("**/a?.{kt,java}") == r"^.*/a.\.(kt|java)$" and files.loose_glob("x") is files.loose_glob("x")


def test_listing_sizes_encodings_and_packages(spark, tmp_path):
    (tmp_path / "src/p").mkdir(parents=True)
    for name, data in (("src/p/A.kt", b"package p\n"), ("src/p/Big.kt", b"x" * 1034), ("src/Bad.kt", b"\xff\xfe"), ("src/N.java", b"// c\npackage a.b ;\n"), ("src/no.txt", b"z")):
        (tmp_path / name).write_bytes(data)
    found = files.read_sources(spark, [f"{tmp_path}/src", f"{tmp_path}/missing"], "kotlin", max_bytes=1024)
    assert [(r["rel_path"], r["size_bytes"], r["text"]) for r in found.collect()] == [("p/A.kt", 10, "package p\n")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "length" in plan
    assert files.list_files(spark, [f"{tmp_path}/src"] * 2, "kotlin").count() == 6
    assert files.list_files(spark, [f"{tmp_path}/src"], "kotlin", 1034).count() == 3
    from pyspark.sql import functions as F

    read = files.read_sources(spark, [f"{tmp_path}/src"], "java")
    assert read.select(files.package_of(F.col("text"), "java")).first()[0] == "a.b"
    assert files.resolve_path("a/b", "/base") == "/base/a/b" and files.resolve_path("s3://x/y", "/base") == "s3://x/y"
    assert files.list_files(spark, [f"{tmp_path}/missing"], "java").count() == 0


def test_generated_files_hold_all_events_and_grow_with_them(spark):
    rows = [(k, 1 + k % 2, t, f'{{"k": {k % 9}}}') for k, t in enumerate(("view", "signup", "purchase", "click", "error") * 8)] + [(5000, 1, "view", '{"k": 1}')]
    events = spark.createDataFrame(rows, "event_id long, user_id int, event_type string, props string")
    made = {(r["language"], r["path"]): r["text"] for r in generated.sources(events).collect()}
    assert {p for _, p in made} == {f"/src/U{u}x{s}.{x}" for u, s in ((1, 0), (2, 0), (1, 2)) for x in ("kt", "java")}
    assert made["kotlin", "/src/U1x0.kt"].count("\n") == 4 + 8 * 20 + 3 and made["java", "/src/U1x2.java"].count("\n") == 4 + 8
    assert all(len(t.split("\n")) == 8 for x in (generated.KOTLIN, generated.JAVA) for t in x.values())


def test_linked_folders_are_skipped(spark, tmp_path):
    for name in ("src/a/b/One.kt", "src/Two.kt", "out/Three.kt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("package p\n")
    (tmp_path / "src/Large.kt").write_text("x" * 100)
    plain = lambda: {r["rel_path"]: r["content"] for r in files.list_files(spark, [str(tmp_path / "src")], "kotlin", 50).collect()}
    want = {"a/b/One.kt": b"package p\n", "Two.kt": b"package p\n"}
    assert plain() == want
    (tmp_path / "src/a/cycle").symlink_to(tmp_path / "src")
    (tmp_path / "src/outside").symlink_to(tmp_path / "out")
    (tmp_path / "src/a/Four.kt").symlink_to(tmp_path / "out/Three.kt")
    assert plain() == want | {"a/Four.kt": b"package p\n"}
    assert files.walk(spark, str(tmp_path / "src")) == ([str(tmp_path / x) for x in ("src", "src/a", "src/a/b")], True)


def test_older_mode_reads_no_further_than_the_package(monkeypatch):
    from callweave.sources import kotlin_tree, tokens

    assert next(tokens.tokens("/* x */ \n\n package")) == ("name", "package", 11, 3)
    text = "package a.b; // c\nfun f() { if (x) y() }"
    assert [r[:3] for r in kotlin_tree.legacy_rules(text, "F.kt", "a.b")] == [("a.b.FKt", "f", k) for k in ("enter", "exit", "if-true", "if-false")]
    monkeypatch.setattr(kotlin_tree, "Source", None)
    assert list(kotlin_tree.legacy_rules(text, "F.kt", "a.c")) == []
