"""Rotation by pointers against the rule told row by row."""

import random

import pytest
from pyspark.sql import functions as F

from callweave.operators import dispatch, rotation


def fold(rows, header, most):
    """(shard, place) -> (rotation, seq), each shard read in order."""
    state, out = {}, {}
    for shard, place, size in sorted(rows):
        n, held, seq = state.get(shard, (1, header, 0))
        if held + size > most:
            n, held = n + 1, header
        state[shard] = (n, held + size, seq + 1)
        out[shard, place] = (n, seq)
    return out


def rules(spark, rows):
    df = spark.createDataFrame([(s, p, "x" * (b - 2)) for s, p, b in rows], "shard int, place long, rule_text string")
    return df.withColumn("turn", F.struct(F.col("place"))).withColumn("place", F.struct("place"))


def sizes(seed, kind, n):
    r = random.Random(seed)
    draw = {"same": lambda: 40, "mixed": lambda: r.choice([2, 3, 30, 60, 200, 900]), "huge": lambda: r.choice([2, 5, 5000])}[kind]
    return [(r.choice([0, 0, 0, 2, 5]), k, draw()) for k in range(n)]


@pytest.mark.parametrize("kind,header,most,stretch", [("same", 10, 400, 16 << 20), ("mixed", 10, 100, 64), ("huge", 60, 4060, 1000), ("mixed", 500, 400, 128), ("same", 0, 1, 32), ("mixed", 10, 10**9, 16 << 20)])
def test_files_begin_where_a_fold_says(spark, monkeypatch, kind, header, most, stretch):
    monkeypatch.setattr(rotation, "STRETCH", stretch)
    rows = sizes(header + most, kind, 300)
    got = dispatch.rotated(rules(spark, rows).repartition(5), header, most, 6)
    places = {(s, k): p for s in {x[0] for x in rows} for k, (_, p, _) in enumerate(sorted(x for x in rows if x[0] == s))}
    assert {(r["shard"], places[r["shard"], r["seq"]]): (r["rotation"], r["seq"]) for r in got.collect()} == fold(rows, header, most)


def test_no_rotation_no_rules_and_repeated_rules(spark):
    rows = [(0, 1, 10), (0, 1, 10), (0, 2, 10), (3, 1, 7)]
    got = sorted((r["shard"], r["rotation"], r["seq"], r["bytes"]) for r in dispatch.rotated(rules(spark, rows), 5, 0, 4).collect())
    assert got == [(0, 0, 0, 10), (0, 0, 1, 10), (0, 0, 2, 10), (3, 0, 0, 7)]
    got = sorted((r["shard"], r["rotation"], r["seq"]) for r in dispatch.rotated(rules(spark, rows), 5, 25, 4).collect())
    assert got == [(0, 1, 0), (0, 1, 1), (0, 2, 2), (3, 1, 0)]
    assert dispatch.rotated(rules(spark, rows).limit(0), 5, 25, 4).collect() == []


def test_one_shard_runs_in_many_tasks_without_python(spark):
    rows = rules(spark, [(0, k, 100) for k in range(20_000)])
    got = dispatch.rotated(rows, 0, 1000, 1)
    assert "Python" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "InPandas" not in plan
    assert got.groupBy("rotation").count().where("count <> 10").count() == 0
    numbers = rotation.numbered(rows.select("shard", "place", F.lit(100).cast("bigint").alias("bytes")), ["shard"], ["place"])
    assert numbers.rdd.getNumPartitions() > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_texts_go_along_and_are_not_joined(spark):
    got = dispatch.rotated(rules(spark, [(k % 3, k, 50 + k % 90) for k in range(400)]), 10, 500, 3)
    above, union, _ = got._jdf.queryExecution().executedPlan().toString().partition("Union")
    assert union and "Join" not in above
    assert all(len(r["rule_text"]) + 2 == r["bytes"] == 50 + (3 * r["seq"] + r["shard"]) % 90 for r in got.collect())
