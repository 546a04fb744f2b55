"""Rules of a stream into sharded files that are rotated by size and time.

Each micro-batch writes whole the files it adds to: those that it ends, and the open
file of each shard, which the next one goes on with. What open files hold is kept as a
table for each batch below the output's own folder, so a batch that runs again after a
failure begins where the one before it ended and replaces its own files. Without limits
each micro-batch makes a file of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callweave.functions import text
from callweave.operators import dispatch
from callweave.plans import sink
from callweave.streaming import rotating


def write_batch(rules: DataFrame, batch_id: int, path: str, header: str, shards: int, prefix: str = "tracing-", gzip: bool = False) -> list[str]:
    """The files of one batch of rules (shard_key, rule_text); shards without rules get none."""
    dealt = dispatch.sharded(rules, shards).select("shard", F.lit(batch_id + 1).alias("rotation"), F.xxhash64("rule_text").alias("seq"), "rule_text")
    return _publish(dealt, path, header, prefix, gzip)


def _publish(rows: DataFrame, path: str, header: str, prefix: str, gzip: bool) -> list[str]:
    """Write the files that rows (shard, rotation, seq, rule_text) make up; a rule without text gives a file its header only."""
    named = rows.withColumn("file", text.file_name(prefix, F.col("shard"), F.col("rotation"), gzip))
    told = named.where("rule_text is not null").select("file", "seq", F.concat("rule_text", F.lit("\n")).alias("value"))
    heads = named.select("file").distinct().select("file", F.lit(-(1 << 63)).cast("bigint").alias("seq"), F.lit(header.removesuffix("\n")).alias("value"))
    return sink.write_files(told.unionByName(heads), path, gzip)


class _Open:
    """What the open files of a stream hold, by batch, below the output folder."""

    def __init__(self, spark, path: str):
        self.spark, self.home = spark, f"{path.rstrip('/')}/_open"
        self.jvm = spark._jvm.org.apache.hadoop.fs
        self.fs = self.jvm.Path(self.home).getFileSystem(spark._jsc.hadoopConfiguration())

    def _batches(self) -> list[int]:
        where = self.jvm.Path(self.home)
        names = [x.getPath().getName() for x in self.fs.listStatus(where)] if self.fs.exists(where) else []
        return sorted(int(n) for n in names if re.fullmatch(r"\d+", n))

    def before(self, batch_id: int) -> DataFrame:
        """The rows of open files after the last batch before this one."""
        earlier = [b for b in self._batches() if b < batch_id]
        read = self.spark.read.schema(rotating.ROTATED)
        return read.parquet(f"{self.home}/{earlier[-1]}") if earlier else self.spark.createDataFrame([], rotating.ROTATED)

    def after(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.home}/{batch_id}")
        # this batch may run again and then reads the one before it
        for old in [b for b in self._batches() if b < batch_id][:-1]:
            self.fs.delete(self.jvm.Path(f"{self.home}/{old}"), True)


def append_batch(rows: DataFrame, batch_id: int, path: str, header: str, prefix: str = "tracing-", gzip: bool = False) -> list[str]:
    """Add a batch of rotated rows (shard, rotation, seq, rule_text) to the files of a stream."""
    state = _Open(rows.sparkSession, path)
    before = state.before(batch_id)
    # a row for each shard of the batch
    reach = rows.groupBy("shard").agg(F.min("rotation").alias("first"), F.max("rotation").alias("last"), F.min("seq").alias("seq"))
    going_on = before.join(reach.select("shard", F.col("first").alias("rotation")), ["shard", "rotation"], "left_semi")
    touched = rows.unionByName(going_on)
    # a first rule larger than a file leaves the shard's first file without rules
    bare = reach.where("seq = 0 and first > 1").select("shard", F.lit(1).alias("rotation"), F.lit(0).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("rule_text"))
    names = _publish(touched.unionByName(bare), path, header, prefix, gzip)
    still = touched.join(reach.select("shard", F.col("last").alias("rotation")), ["shard", "rotation"], "left_semi")
    state.after(batch_id, still.unionByName(before.join(reach, "shard", "left_anti")))
    return names


def start(rules: DataFrame, path: str, checkpoint: str, header: str, shards: int, interval: str | None = None, max_bytes: int = 0, interval_ms: int = 0, prefix: str = "tracing-", gzip: bool = False) -> StreamingQuery:
    """Write a stream of rules (shard_key, rule_text, and `at` where it orders the rules of a delivery).

    max_bytes and interval_ms begin new files. `interval` is how often rules are taken; None takes what is there and
    stops, so that no file ends by time. Limits need keyed state in a store that holds it, which the query is started with."""
    interval_ms = interval_ms if interval else 0
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    limited = max_bytes > 0 or interval_ms > 0
    dealt = rules
    if limited:
        dealt = rotating.rotated(dispatch.sharded(rules, shards), len(header.encode()), max_bytes, interval_ms)

    def put(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if kept.isEmpty():
                return
            if limited:
                append_batch(kept, batch_id, path, header, prefix, gzip)
            else:
                write_batch(kept, batch_id, path, header, shards, prefix, gzip)
        finally:
            kept.unpersist()

    conf, name = rules.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    set_before = conf.get(name, None)
    if limited:
        conf.set(name, rotating.STORE)  # the query keeps the setting it was started under
    try:
        return dealt.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        if limited:
            conf.set(name, set_before) if set_before else conf.unset(name)
