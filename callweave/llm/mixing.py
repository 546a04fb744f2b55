"""Mixing sources to target weights, in DataFrame expressions only.

Tokens (here: words) are summed per source; a budget is shared over the sources
by weight, no source above `cap` times its size, the excess reshared until none
is above. A source's repetition rate is target / size. Each document is emitted
floor(rate) times and once more if its hash-seeded draw is below the fraction.

A draw depends on the source's seed and the doc_id only, so reruns agree. Of
SEEDS candidate seeds each source takes the one whose draws bring its words
closest to its target; all candidates are summed in one pass.

Defined results: null text has size 0; null sources form one source, placed
last; a source without words gets target 0 and no copies; rows that repeat a
doc_id share its draw; an empty table gives an empty result; other columns are
carried through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.llm._shared import materialise, word_count

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
CAP = 2.0
SEEDS = 16


def _draw(doc_id: Column, seed: Column | int) -> Column:
    """A number in [0, 1): eight hex digits of an md5; four seeds share one hash."""
    group, part = (F.floor(seed / 4), seed % 4) if isinstance(seed, Column) else (F.lit(seed // 4), F.lit(seed % 4))
    key = F.md5(F.concat(group.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(key, part * 8 + 1, F.lit(8)), 16, 10).cast("bigint") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) for sizes (source, size).

    Each round is one aggregate over the source table that returns three numbers; only those reach the driver."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights)).cast("int"))
    sources = materialise(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, closed = None, -1
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("weight") > F.lit(cap) * F.col("source_size")
        n, capped, open_weight = sources.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == closed:
            break
        closed, level = n, (budget * total - cap * (capped or 0)) / open_weight if open_weight else float("inf")
    target = F.when(F.lit(level or 0.0) * F.col("weight") > F.lit(cap) * F.col("source_size"), F.lit(cap) * F.col("source_size")).otherwise(F.lit(level or 0.0) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def source_rates(sizes: DataFrame, seeds: int = SEEDS, **options) -> DataFrame:
    """(source, source_size, target, rate, seed) for sizes (doc_id, source, size)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = materialise(source_targets(sizes, **options).withColumn("rate", rate), "mix-rates")
    r = rated.select(F.col("source").alias("of"), "rate")
    fraction = F.col("rate") - F.floor("rate")
    extra = [F.sum(F.when(_draw(F.col("doc_id"), k) < fraction, F.col("size")).otherwise(0)).alias(f"seed{k}") for k in range(seeds)]
    drawn = sizes.join(r, F.col("source").eqNullSafe(F.col("of"))).groupBy("of").agg(*extra)
    wanted = (F.col("rate") - F.floor("rate")) * F.col("source_size")
    best = F.array_min(F.array(*(F.struct(F.abs(F.col(f"seed{k}") - wanted).alias("off"), F.lit(k).alias("k")) for k in range(seeds))))["k"]
    return materialise(rated.join(drawn, F.col("source").eqNullSafe(F.col("of"))).select("source", "source_size", "target", "rate", best.alias("seed")), "mix-seeds")


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    """floor(rate), and one more if the document's draw is below the fraction."""
    more = F.when(_draw(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)
    return (F.floor(rate) + more).cast("bigint")


def document_sizes(docs: DataFrame) -> DataFrame:
    return materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document."""
    sizes = document_sizes(docs)
    rates = source_rates(sizes, **options).withColumnRenamed("source", "of")
    n = copies(F.col("doc_id"), F.col("rate"), F.col("seed"))
    out = sizes.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: docs with each row repeated as often as the mix takes it."""
    rates = source_rates(document_sizes(docs), **options)
    rates = rates.select(F.struct("source", "rate", "seed").alias("__mix"))
    joined = docs.join(rates, docs["source"].eqNullSafe(F.col("__mix.source")))
    n = copies(docs["doc_id"], F.col("__mix.rate"), F.col("__mix.seed"))
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), n.cast("int")))).select(*(docs[c] for c in docs.columns))
