"""Size rotation of ordered rules without reading a shard as a stream.

A file that begins at a rule ends before the first rule that overflows it, so each rule
has one next file: a pointer. Which rules do begin files is what can be reached from a
shard's start. Only numbers and bytes take part; texts are sorted once with their rules.

1. The rules are sorted by ranges of (shard, turn, place); sums within a range plus the
   sums of the ranges before give each rule its number and the bytes up to it.
2. Pointers: the bytes at which a file is full are looked up among the bytes up to each
   rule. Both are cut into stretches of STRETCH bytes at most, and each lookup is settled
   in its stretch among the rules that touch it.
3. Doubling: a level's pointers go twice as far as those of the level before and are
   kept only for rules that some pointer of that level reaches, so tables shrink as
   paths meet. Going back down the levels finds the beginnings between those known.

Defined results: rules of equal (shard, turn, place) are ordered by their text's hash;
a rule larger than a file has one of its own, so one that comes first leaves its shard a
file without rules; no rules give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.functions import shared

#: Bytes of a stretch at most: what one window over a shard's rules holds.
STRETCH = 16 << 20


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows with `k` and `upto`, their number from 1 and the sum of `bytes` up to them, by keys in order, in place of what they are ordered by.

    Keys of any size are spread over tasks: only a row for each key and range meets in one place."""
    shared.checkpoints(rows.sparkSession)
    ranged = rows.repartitionByRange(*keys, *order).withColumn("block", F.spark_partition_id()).checkpoint()
    within = Window.partitionBy("block", *keys).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy("block", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size"))
    blocks = blocks.select("block", *keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__size"))
    placed = ranged.withColumns({"k": F.row_number().over(within).cast("bigint"), "upto": F.sum("bytes").over(upto)}).drop(*order)
    # a row for each key and range: of ranges there are as many as shuffle partitions
    placed = placed.join(F.broadcast(blocks), ["block", *keys])
    return placed.withColumns({"k": F.col("k") + F.col("__n"), "upto": F.col("upto") + F.col("__size")}).drop("block", "__n", "__size").checkpoint()


def _stretch(at: str, width: int) -> Column:
    return F.floor(F.col(at) / width).cast("bigint")


def _stretches(first: str, last: str, width: int) -> Column:
    """The stretches that begin after byte `first` and not after byte `last`, if any."""
    a, b = _stretch(first, width) + 1, _stretch(last, width)
    return F.when(a <= b, F.sequence(a, b))


def next_files(rows: DataFrame, room: int, width: int) -> DataFrame:
    """(shard, k, to, at): for each rule and, as k 0, each shard's start, the first rule that does not fit into a file begun there.

    at is the bytes before that rule. `held` is what a shard's first file has of rules written earlier. A rule is listed
    under every stretch that it touches, so a lookup finds its answer in its own stretch; one row for each shard is broadcast."""
    shards = rows.groupBy("shard").agg(F.max("k").alias("n"), F.max("held").alias("held"))
    values = rows.select("shard", "k", "upto", (F.col("upto") - F.col("bytes")).alias("before"))
    rule = F.struct("k", "before")
    nothing = F.lit(None).cast(values.select(rule.alias("x")).schema["x"].dataType)
    none = F.lit(None).cast("bigint")
    wanted = values.select("shard", "k", (F.col("before") + room).alias("at"), "upto").union(shards.select("shard", F.lit(0).cast("bigint"), F.lit(room) - F.col("held"), none))
    both = wanted.select("shard", F.greatest(_stretch("at", width), F.lit(0)).alias("b"), "at", "k", "upto", nothing.alias("rule"))
    touched = F.explode(F.sequence(_stretch("before", width), _stretch("upto", width)))
    both = both.union(values.select("shard", touched.alias("b"), F.col("upto").alias("at"), none.alias("k"), none.alias("upto"), rule.alias("rule")))
    # going down, what overflows stands before the lookup; a rule that fills a file to its last byte stands after
    larger = Window.partitionBy("shard", "b").orderBy(F.col("at").desc(), F.col("rule").isNull().desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("hit", F.last("rule", ignorenulls=True).over(larger)).where("k is not null")
    found = found.join(F.broadcast(shards.select("shard", "n")), "shard")
    # a file holds one rule at least
    alone = F.col("hit.k") <= F.col("k")
    to = F.when(alone, F.when(F.col("k") < F.col("n"), F.col("k") + 1)).otherwise(F.col("hit.k"))
    return found.select("shard", "k", to.alias("to"), F.when(alone, F.col("upto")).otherwise(F.col("hit.before")).alias("at"))


def beginnings(pointers: DataFrame) -> DataFrame:
    """(shard, k, m): the rules that begin files after the first, m from 1, reached from k 0 of (shard, k, to)."""
    jump = pointers.select("shard", "k", "to", (F.col("k") == 0).alias("path")).checkpoint()
    levels = [jump]
    while not jump.where("to is not null").isEmpty():
        reached = jump.where("to is not null").groupBy("shard", "to").agg(F.max("path").alias("path")).withColumnRenamed("to", "k")
        step = jump.select("shard", "k", "to")
        once = reached.join(step, ["shard", "k"])
        twice = step.select("shard", F.col("k").alias("to"), F.col("to").alias("far"))
        jump = once.join(twice, ["shard", "to"], "left").select("shard", "k", F.col("far").alias("to"), "path").checkpoint()
        levels.append(jump)
    # level r holds pointers over 2^r files; its marked rule is number 2^r - 1
    known = None
    for r in range(len(levels) - 1, -1, -1):
        marked = levels[r].where("path").select("shard", "k", F.lit((1 << r) - 1).cast("bigint").alias("m"))
        if known is not None:
            step = levels[r].select("shard", "k", "to")
            on = known.join(step, ["shard", "k"], "left")
            both = F.array(F.struct(F.col("k"), F.col("m")), F.struct(F.col("to").alias("k"), (F.col("m") + (1 << r)).alias("m")))
            known = on.select("shard", F.explode(both).alias("x")).select("shard", "x.k", "x.m").where("k is not null")
            marked = known.union(marked)
        known = marked
    return known.where("k > 0")


def rotations(rows: DataFrame, header_bytes: int, max_bytes: int) -> DataFrame:
    """rows (shard, k, bytes, upto, held, ..) with `rotation`: how many files of its shard began up to a rule, and 1.

    Other columns of rows are shuffled once, to the stretches in which the rules begin."""
    room = max_bytes - header_bytes
    if rows.where(F.col("upto") + F.col("held") > room).isEmpty():  # no shard fills its first file
        return rows.withColumn("rotation", F.lit(1))
    width = min(max(room, 1 << 16), STRETCH)
    pointers = next_files(rows.select("shard", "k", "bytes", "upto", "held"), room, width).checkpoint()
    files = beginnings(pointers).join(pointers.where("to is not null").groupBy("shard", F.col("to").alias("k")).agg(F.first("at").alias("at")), ["shard", "k"]).checkpoint()
    totals = rows.groupBy("shard").agg(F.max("upto").alias("total"))
    spans = files.select("shard", "m", "at").union(totals.select("shard", F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    spans = spans.join(files.select("shard", (F.col("m") - 1).alias("m"), F.col("at").alias("until")), ["shard", "m"], "left").join(F.broadcast(totals), "shard")
    # the file under which each stretch is entered, and the places at which files begin, stand among the rules
    entered = spans.withColumn("until", F.coalesce("until", "total")).select("shard", F.explode(_stretches("at", "until", width)).alias("b"), F.lit(0).cast("bigint").alias("k"), "m")
    begun = files.select("shard", _stretch("at", width).alias("b"), "k", "m")
    upto = Window.partitionBy("shard", "b").orderBy("k").rangeBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("b", F.floor((F.col("upto") - F.col("bytes")) / width).cast("bigint"))
    marked = placed.unionByName(entered.unionByName(begun), allowMissingColumns=True)
    marked = marked.withColumn("rotation", (F.coalesce(F.max("m").over(upto), F.lit(0)) + 1).cast("int"))
    return marked.where("bytes is not null").select(*rows.columns, "rotation")
