from collections import defaultdict

from callweave.llm import mixing


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Plain resharing until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, left = {}, budget * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def corpus():
    rows = [(k, ["hot", "b", "a", None, "ü", "tiny"][0 if k % 3 == 0 else k % 6], "w " * (k % 17 + 1)) for k in range(900)]
    return rows + [(5000, "tiny", None), (5001, "void", ""), (None, "a", "x y"), (3, "hot", "again here")]


def test_targets_and_taken_words(spark):
    rows = corpus()
    got = [r.asDict() for r in mixing.mix_plan(spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, source string, text string, rate double")).collect()]
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and abs(g["target"] - want[g["source"]]) < 1e-6
        assert 0 <= g["taken"] <= 2 * g["size"]
        taken[g["source"]] += g["taken"]
    assert sum(want.values()) == 1.5 * sum(sizes.values())
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(20, 0.03 * want[s]), (s, n, want[s])


def test_reruns_agree_and_copies_follow_the_plan(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, source string, text string").withColumnRenamed("text", "text")
    docs = docs.selectExpr("*", "1 as copies", "'x' as __copy0")
    plan = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.mix_plan(docs).collect()}
    assert plan == {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.mix_plan(docs.repartition(3)).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    seen = defaultdict(int)
    for r in mixed.collect():
        seen[(r["doc_id"], r["source"], len((r["text"] or "").split()))] += 1
    assert dict(seen) == {k: n for k, n in plan.items() if n}


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [tuple(r)[2:] for r in mixing.mix_plan(blank).select("doc_id", "source", "size", "target", "copies", "taken").collect()] == [(0, 0.0, 0, 0)] * 2
