"""Files of a stream against those of a batch run under the same limits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.operators import dispatch
from callweave.plans import sink as files
from callweave.streaming import rotating, sink

HEAD = "# head\n\n"


def fold(sizes, rotation, held, room):
    out = []
    for s in sizes:
        if held + s > room:
            rotation, held = rotation + 1, 0
        held += s
        out.append(rotation)
    return out, held


@pytest.mark.parametrize("room", [1, 50, 120, 10**6, -5])
def test_rotation_goes_on_where_it_ended(room):
    r = random.Random(room)
    sizes = [r.choice([2, 9, 40, 60, 300]) for _ in range(200)]
    whole, held = fold(sizes, 1, 0, room)
    got, rotation, at = [], 1, 0
    while len(got) < len(sizes):
        part = sizes[len(got) : len(got) + r.randint(1, 30)]
        found, at = rotating.rotate(np.array(part), rotation, at, room)
        got += found.tolist()
        rotation = got[-1]
    assert got == whole and at == held


def rules(spark, n, seed=1):
    r = random.Random(seed)
    rows = [(f"k{r.randrange(6)}", "RULE " + "x" * r.choice([3, 30, 90, 250, 900]), k) for k in range(n)]
    return spark.createDataFrame(rows, "shard_key string, rule_text string, at long")


def contents(path):
    return {p.name: p.read_text() for p in path.iterdir() if p.is_file() and p.suffix == ".btm"}


@pytest.mark.parametrize("cuts", [[300], [1, 11, 150, 300]])
def test_small_and_large_batches_give_the_files_of_a_batch_run(spark, tmp_path, cuts):
    made, shards, most = rules(spark, 300), 3, 2_000
    last = 0
    for k, cut in enumerate(cuts):
        made.where(F.col("at").between(last, cut - 1)).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        last = cut
        stream = spark.readStream.schema(made.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        assert sink.start(stream, f"{tmp_path}/out", f"{tmp_path}/cp", HEAD, shards, max_bytes=most).awaitTermination(120)
    batch = made.withColumn("turn", F.struct("at")).withColumn("place", F.struct("at"))
    turned = dispatch.rotated(dispatch.sharded(batch, shards), len(HEAD), most, shards)
    files.write_files(dispatch.file_lines(turned, HEAD, "tracing-", shards, True), f"{tmp_path}/batch")
    want = {n: c for n, c in contents(tmp_path / "batch").items() if dispatch.NOTHING not in c}
    assert contents(tmp_path / "out") == want and len(want) > 20


def test_a_batch_that_runs_again_replaces_its_own_files(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), rotating.ROTATED)
    first, second = rows((0, 1, 0, "a"), (1, 2, 0, "big")), rows((0, 1, 1, "b"), (0, 2, 2, "c"))
    sink.append_batch(first, 0, str(tmp_path), HEAD)
    for _ in range(2):
        sink.append_batch(second, 1, str(tmp_path), HEAD)
    sink.append_batch(rows((1, 2, 1, "more")), 5, str(tmp_path), HEAD)
    assert contents(tmp_path) == {"tracing-0001-00001.btm": HEAD + "a\n\nb\n\n", "tracing-0001-00002.btm": HEAD + "c\n\n", "tracing-0002-00001.btm": HEAD, "tracing-0002-00002.btm": HEAD + "big\n\nmore\n\n"}


class Held:
    """A state and its timers as the processor sees them."""

    def __init__(self):
        self.value, self.timers = None, []

    getValueState = lambda self, *_: self
    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)


class Now:
    def __init__(self, ms):
        self.getCurrentProcessingTimeInMs = lambda: ms


def test_time_ends_files(spark):
    import pandas as pd

    processor, state = rotating.Rotation(0, 100, interval_ms=1000), Held()
    processor.init(state)
    put = lambda ms, *sizes: [x for f in processor.handleInputRows((4,), iter([pd.DataFrame({"rule_text": ["r"] * len(sizes), "bytes": sizes})]), Now(ms)) for x in zip(f["shard"], f["rotation"], f["seq"])]
    assert put(0, 10, 10) == [(4, 1, 0), (4, 1, 1)] and state.timers == [1000]
    assert put(999, 10) == [(4, 1, 2)]
    list(processor.handleExpiredTimer((4,), Now(1000), None))
    assert put(1001, 10, 95) == [(4, 2, 3), (4, 3, 4)]
    list(processor.handleExpiredTimer((4,), Now(1500), None))
    assert put(1600, 5) == [(4, 3, 5)] and put(2700, 5) == [(4, 4, 6)]
