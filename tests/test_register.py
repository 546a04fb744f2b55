"""Registrations in a stream against the batch form."""

import random

from callweave.functions import evaluate
from callweave.streaming import register


def test_late_registrations_never_win_and_stream_equals_batch(spark, tmp_path):
    r = random.Random(3)
    told = [(k, r.choice(["a", "b", "c", "d", None]), r.choice(["true", "FALSE", "false", "throws", None])) for k in range(60)]
    asked = [(k, r.choice(["a", "b", "c", "d", "unknown", None])) for k in range(30)]
    shuffled = sorted(told, key=lambda _: r.random())
    kinds = {"told": "seq long, rule_id string, outcome string", "asked": "asked long, rule_id string"}
    for k in range(3):  # three deliveries of registrations, then the questions
        spark.createDataFrame(shuffled[k * 20 : k * 20 + 20], kinds["told"]).coalesce(1).write.parquet(f"{tmp_path}/told/{k}")
        spark.createDataFrame(asked if k == 2 else asked[:0], kinds["asked"]).coalesce(1).write.parquet(f"{tmp_path}/asked/{k}")
        read = {n: spark.readStream.schema(s).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{n}") for n, s in kinds.items()}
        found = register.match_stream(read["asked"], read["told"])
        query = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert query.awaitTermination(60)
    got = {(x["asked"], x["rule_id"], x["matched"]) for x in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = evaluate.if_match(spark.createDataFrame(asked, kinds["asked"]), spark.createDataFrame(told, kinds["told"]))
    assert got == {(x["asked"], x["rule_id"], x["matched"]) for x in batch.collect()} and len(got) == 30
    assert {x[2] for x in got} == {True, False}
