import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callweave.functions import evaluate, ids, predicates, text


def java_hash(s):
    h = 0
    data = s.encode("utf-16-be", "surrogatepass")
    for k in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[k : k + 2], "big")) & 0xFFFFFFFF
    return h


def column(spark, values, expression, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(expression(F.col("v"))).collect()]


def test_java_hash_agrees_with_utf16_folds(spark):
    values = ["", "a", "com.example.U1#m2:3", "ü…日本", "x\U0001f600y", "z" * 500]
    assert column(spark, values, ids.java_hash) == [java_hash(v) for v in values]


def test_shards_are_stable_and_even(spark):
    keys = [f"C{k % 97}#m{k % 31}:{k}" for k in range(10_000)]
    shards = column(spark, keys, lambda c: ids.stable_shard(c, 8))
    assert shards == [(java_hash(k) & 0x7FFFFFFF) % 8 for k in keys]
    assert all(0.6 * 1250 <= shards.count(s) <= 1.4 * 1250 for s in range(8))
    assert column(spark, [None, "a"], lambda c: ids.stable_shard(c, 8))[0] == 0
    assert column(spark, ["abc"], lambda c: ids.stable_shard(c, 1)) == [0]


def test_rule_ids(spark):
    row = spark.range(1).select(ids.rule_id(F.lit("C"), F.lit("m"), F.lit(42), F.lit("expr")), ids.rule_id(F.lit("C"), F.lit("m"), F.lit(43), F.lit("expr"))).first()
    assert row[0] == "5de496" and row[1] != row[0]
    keys = spark.range(1).select(ids.shard_key(F.lit("C"), F.lit("m"), F.lit(7)), ids.shard_key(F.lit("C"), F.lit("m"), F.lit(None).cast("int"))).first()
    assert tuple(keys) == ("C#m:7", "C#m:0")
    kept, made = spark.range(1).select(ids.correlation_id(F.lit("x")), ids.correlation_id(F.lit(" "))).first()
    assert kept == "x" and len(made) == 36


def test_text_functions(spark):
    assert column(spark, ['a"b\\c\nd\te\r', "abcdef"], lambda c: text.escape(c)) == ['a\\"b\\\\c\\nd\\te\\r', "abcdef"]
    assert column(spark, ["abcdef", "ab"], lambda c: text.escape(c, 3)) == ["abc…", "ab"]
    assert column(spark, ["a // b", "x = 'http://y'"], text.strip_line_comment) == ["a ", "x = 'http:"]
    assert column(spark, ["  a \n\t b "], text.collapse_spaces) == ["a b"]
    assert column(spark, ["A.kt", "a.b.kt", "none"], text.strip_extension) == ["A", "a.b", "none"]
    assert column(spark, ["a\nbc\nd"], lambda c: text.line_at(c, F.lit(3))) == [2]
    assert column(spark, [None, "x\ny", "z" * 301], text.preview) == ["null", "x\\ny", "z" * 300 + "…"]
    assert column(spark, [None, "a\r\n"], text.one_line) == ["", "a\\r\\n"]
    names = spark.range(1).select(text.file_name("t-", F.lit(0), F.lit(0)), text.file_name("t-", F.lit(11), F.lit(3), True)).first()
    assert tuple(names) == ("t-0001.btm", "t-0012-00003.btm.gz")


CASES = [
    ("a == 1", "equals", "a == 1"),
    ("  (( a == 'x' ))", "equals", "a == 'x'"),
    ("o instanceof a.B$C", "instanceof", "o instanceof a.B$C"),
    ("a == 1 && b == 2 && c == 3", "and", "((a == 1) AND (b == 2)) AND (c == 3)"),
    ("a == 1 || b == 2", "or", "(a == 1) OR (b == 2)"),
    ("a == 1 && f(x)", "original", "a == 1 && f(x)"),
    ("a == 1.5", "original", "a == 1.5"),
    ("a == true", "original", "a == true"),
    ("x > 0", "original", "x > 0"),
    (" ", "original", "true"),
]


@pytest.mark.parametrize("condition,kind,inline", CASES)
def test_classification(condition, kind, inline):
    assert (predicates.classify(condition).kind, predicates.classify(condition).inline()) == (kind, inline)


def test_precedence_is_kept_only_if_strict():
    mixed = "a == 1 && b == 2 || c == 3"
    assert predicates.classify(mixed).inline() == "(a == 1) AND ((b == 2) OR (c == 3))"
    assert predicates.classify(mixed, strict=True).inline() == "((a == 1) AND (b == 2)) OR (c == 3)"
    assert predicates.classify("(a == 1 && b == 2)").kind == "original"
    assert predicates.classify("(a == 1 && b == 2)", strict=True).kind == "and"


def test_safe_mode_table():
    eq, original, both = (predicates.classify(t) for t in ("a == 1", "f(x)", "a == 1 && b == 2"))
    e = predicates.EVALUATOR
    for p, inline, called in ((eq, "a == 1", f"{e}.ifEq(a, 1)"), (both, "(a == 1) AND (b == 2)", f"{e}.and({e}.ifEq(a, 1), {e}.ifEq(b, 2))")):
        assert p.guard("id") == p.guard("id", safe=True) == p.guard("id", force=True) == inline
        assert p.guard("id", safe=True, force=True) == called
    assert original.guard("id") == "f(x)" and original.guard("id", safe=True) == original.guard("id", True, True) == f'{e}.ifMatch("id")'


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "==", "!=", "&&", "||", "(", ")", "instanceof", "T", "1", "-2.5", "'q'", '"s"', " ", "f(", "[", "!"]), max_size=14).map(" ".join))
def test_translation_never_fails_and_balances(condition):
    out = predicates.translate(condition)
    assert out == "true" or predicates.EVALUATOR in out and out.count("(") == out.count(")")
    predicates.classify(condition).guard("id", True, True)


def test_column_forms_agree_with_the_parser(spark):
    r = random.Random(1)
    pool = ["a == 1", "x.y == 'q'", "b instanceof p.T", "flag", "a != 2", "a  ==  MAX_1", "a = 1"]
    texts = list({r.choice(pool) + r.choice(["", " ", "x"]) for _ in range(60)})
    df = spark.createDataFrame([(t,) for t in texts], "t string").where(predicates.is_simple(F.col("t")))
    rows = df.select("t", predicates.simple_kind(F.col("t")), predicates.simple_inline(F.col("t")), predicates.simple_helper(F.col("t"), F.lit("id"))).collect()
    for t, kind, inline, helper in rows:
        p = predicates.classify(t)
        assert (p.kind, p.inline(), p.helper("id")) == (kind, inline, helper)


def test_if_eq(spark):
    schema = "i int, l long, d double, f float, m decimal(10,2), s string, b boolean"
    from decimal import Decimal

    df = spark.createDataFrame([(1, 1, 1.0, 0.1, Decimal("1.00"), "1", True), (None, None, None, None, None, None, None), (2, 3, 0.1, 0.1, Decimal("0.10"), "x", False), (5, None, 1e30, 1.0, None, None, None)], schema)
    pairs = {"il": [True, True, False, False], "id": [True, True, False, False], "im": [True, True, False, False], "df": [False, True, True, False], "is": [False, True, False, False], "ss": [True] * 4, "dm": [True, True, True, False], "dd": [True] * 4, "sb": [False, True, False, True]}
    for (a, b), want in pairs.items():
        assert [r[0] for r in df.select(evaluate.if_eq(df, a, b)).collect()] == want, (a, b)


def test_registry_is_fail_open(spark):
    registered = spark.createDataFrame([(1, "a", "true"), (2, "a", "false"), (3, "b", "throws"), (4, None, "false"), (5, "c", None)], "seq int, rule_id string, outcome string")
    rules = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("new",)], "rule_id string")
    assert {r["rule_id"]: r["matched"] for r in evaluate.if_match(rules, registered).collect()} == {"a": False, "b": True, "c": True, None: True, "new": True}


def test_type_tests(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "D"), ("D", "E"), ("A", "I"), ("X", None)], "type string, supertype string")
    closure = evaluate.type_closure(edges)
    assert {r["ancestor"] for r in closure.where("type = 'A'").collect()} == set("ABCDEI")
    values = spark.createDataFrame([("A",), ("E",), (None,), ("Q",)], "type string")
    assert [r["is_instance"] for r in evaluate.if_instance_of(values, closure, "E").orderBy("type").collect()] == [False, True, True, False]
    assert not any(r["is_instance"] for r in evaluate.if_instance_of(values, closure, "").collect())


def test_truth_of_translated_conditions(spark):
    cases = [("a == 1", True), ("a != 1", False), ("a == 2 || b == 'x'", True), ("(a == 1 && (b == 'y' || b == 'x')) && a == 1", True), ("a == 1 && (b == 'y' || (b != 'x' || a == 3))", False), ("c == 1", False), ("v instanceof T", True), ("f(x)", True), ('b == "x"', True), ("b == 'x.*'", False), (None, None), (" || ".join(["a == 5"] * 30 + ["b == 'x'"]), True)]
    texts = [(t, predicates.translate(t) if t else None, want) for t, want in cases]
    df = spark.createDataFrame(texts, "t string, translated string, want boolean").withColumns({"a": F.lit("1"), "b": F.lit("x"), "c": F.lit(None).cast("string")})
    got = df.select("t", "want", predicates.evaluated(F.col("translated"), {"a": F.col("a"), "b": F.col("b"), "c": F.col("c")}, F.lit(True)).alias("got")).collect()
    assert [(r["t"], r["got"]) for r in got] == [(r["t"], r["want"]) for r in got]


def test_closure_of_a_chain_a_fan_and_a_cycle(spark):
    chain = [(f"c{k}", f"c{k + 1}") for k in range(199)]
    fan = [(f"f{k}", "top") for k in range(10_000)] + [("top", "Any")]
    cycle = [("x", "y"), ("y", "z"), ("z", "x"), ("x", "x"), ("loose", None)]
    edges = spark.createDataFrame(chain + fan + cycle + chain[:5], "type string, supertype string")
    got = evaluate.type_closure(edges)
    assert got.count() == got.distinct().count() == 200 * 201 // 2 + 10_000 * 3 + 3 + 9
    assert got.where("type = 'c0'").count() == 200 and got.where("type = 'f77'").count() == 3
    assert {tuple(r) for r in got.where("type = 'x'").collect()} == {("x", "x"), ("x", "y"), ("x", "z")}


def test_forms_by_shape_are_those_of_each_text(spark):
    import random

    from callweave.functions import predicates

    r = random.Random(3)
    bits = ["a1", "b", "x.y2", "12", "-7", "3.50", ".5", "007", '"q 10"', "'9'", "LIM_4", "==", "==", "!=", "instanceof", "T10", "p.T3", "&&", "||", "(", ")", " ", "f5(6)", "c[1]", "true", "0", "100"]
    texts = [" ".join(r.choice(bits) for _ in range(r.randint(0, 9))) for _ in range(1500)] + ["a == 1", "a == 22 && b2 == 'x0'", "", " ", "10", "a10 == 0 || (b == 100 && c != 20)"]
    frame = spark.createDataFrame([(t,) for t in set(texts)], "condition_text string")
    for evaluator, strict in ((predicates.EVALUATOR, False), ("my0.E10", True)):
        got = predicates.with_forms(frame, strict, evaluator)
        want = predicates.condition_forms(frame, strict, evaluator)
        order = want.columns
        assert sorted(map(tuple, got.select(order).collect())) == sorted(map(tuple, want.collect()))
    few = predicates.with_forms(spark.range(1000).selectExpr("'a' || id || ' == ' || id as condition_text"), few=True)
    assert few.count() == 1000
    shapes = predicates.condition_forms(spark.range(1000).selectExpr("regexp_replace('a' || id || ' == ' || id, '[0-9]+', '0') as condition_text"))
    assert shapes.count() == 1
