"""Which rules are written, and where: prefix filter, minimum branches, shards, rotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import ids, shared, text
from callweave.operators import rotation
from callweave.operators.events import any_prefix

BRANCH = ":if-|:is-|:when|:case"
#: Fixed value: what a file of a shard without rules says.
NOTHING = "# No matching sources were found."


def branch_counts(rules: DataFrame) -> DataFrame:
    """(method_key, branches): rules whose text names a branch, by method; summed before the shuffle."""
    return rules.where("method_key is not null").groupBy("method_key").agg(F.count_if(F.col("rule_text").rlike(BRANCH)).alias("branches"))


def selected(rules: DataFrame, prefixes: list[str] = (), min_branches: int = 0, strict: bool = False) -> DataFrame:
    """Rules that pass the prefix filter and, if asked for, whose method has enough branch rules.

    With a minimum, rules without a method key form one group that is always large enough and whose first rule
    decides the prefix filter for all of it; strict filters each of them by itself. `turn` orders what is written:
    methods by their first rule."""
    allowed = any_prefix(F.col("fqcn"), list(prefixes))
    if min_branches <= 0:
        return rules.where(allowed).withColumn("turn", F.col("place"))
    counts = rules.where("method_key is not null").groupBy("method_key").agg(F.count_if(F.col("rule_text").rlike(BRANCH)).alias("branches"), F.min("place").alias("turn"))
    keyed = rules.join(counts.where(F.col("branches") >= min_branches).drop("branches"), "method_key").where(allowed)
    free = rules.where("method_key is null")
    if strict or not prefixes:
        free, turn = free.where(allowed), F.col("place")
    else:
        first = free.agg(F.min_by("fqcn", "place").alias("fqcn"), F.min("place").alias("turn")).first()
        free = free.where(F.lit(first["fqcn"] is not None and any(first["fqcn"].startswith(p) for p in prefixes)))
        turn = F.col("place")
    return keyed.unionByName(free.withColumn("turn", turn).select(*keyed.columns))


def sharded(rules: DataFrame, shards: int) -> DataFrame:
    """rules with the shard of their key."""
    return rules.withColumn("shard", ids.stable_shard(F.col("shard_key"), max(1, shards)))


def rotated(rules: DataFrame, header_bytes: int, max_bytes: int, shards: int) -> DataFrame:
    """(shard, rotation, seq, rule_text, bytes): each shard's rules in order, a new file before a rule that would overflow it.

    Rules are sorted by operators.rotation, over as many tasks as there are ranges of them, and take their texts along;
    where new files begin is found from numbers and sizes. max_bytes 0 turns rotation off; then rotation is 0, else it
    counts from 1."""
    shared.checkpoints(rules.sparkSession)
    bytes_of = (F.coalesce(F.octet_length("rule_text"), F.lit(0)) + 2).cast("bigint")
    told = rules.select("shard", "turn", "place", F.xxhash64("rule_text").alias("mark"), "rule_text", bytes_of.alias("bytes"), F.lit(0).cast("bigint").alias("held"))
    told = told.checkpoint()  # rules are made once, not for the ranges and for the sort
    placed = rotation.numbered(told, ["shard"], ["turn", "place", "mark"])
    turned = rotation.rotations(placed, header_bytes, max_bytes) if max_bytes > 0 else placed.withColumn("rotation", F.lit(0))
    return turned.select("shard", "rotation", (F.col("k") - 1).alias("seq"), "rule_text", "bytes")


def file_lines(rotated_rules: DataFrame, header: str, prefix: str, shards: int, rotating: bool, gzip: bool = False) -> DataFrame:
    """(file, seq, value): the lines of every output file, headers first; shards without rules say so."""
    spark = rotated_rules.sparkSession
    named = lambda df: df.withColumn("file", text.file_name(prefix, F.col("shard"), F.col("rotation"), gzip))
    rules = named(rotated_rules).select("file", "seq", F.concat("rule_text", F.lit("\n")).alias("value"))
    used = rotated_rules.select("shard", "rotation").distinct()
    first = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(1 if rotating else 0).alias("rotation"))
    files = named(used.union(first).distinct())
    heads = files.select("file", F.lit(-2).cast("bigint").alias("seq"), F.lit(header.removesuffix("\n")).alias("value"))
    empty = named(first.join(used.select("shard").distinct(), "shard", "left_anti"))
    return rules.unionByName(heads).unionByName(empty.select("file", F.lit(-1).cast("bigint").alias("seq"), F.lit(NOTHING).alias("value")))
