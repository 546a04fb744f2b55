"""Null-safe predicate evaluation: equality by kind of value, type tests, fail-open lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions import shared

EXACT = "decimal(38,18)"


def _number(value: Column, kind: T.DataType) -> Column:
    """A float counts by its decimal text, so 0.1f equals 0.1."""
    return value.cast("string").cast("double") if isinstance(kind, T.FloatType) else value


def if_eq(df: DataFrame, a: str, b: str) -> Column:
    """True where both are null or equal in value; never null.

    Numbers of any type compare by value, a string and a number never equal each other."""
    left, right = (df.schema[c].dataType for c in (a, b))
    x, y = df[a], df[b]
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        m, n = _number(x, left), _number(y, right)
        exact = m.try_cast(EXACT) == n.try_cast(EXACT)
        # beyond what a decimal holds, doubles compare as they are
        same = F.when(m.isNull() | n.isNull(), m.isNull() & n.isNull()).otherwise(F.coalesce(exact, m.cast("double") == n.cast("double")))
    elif type(left) is type(right):
        same = x.eqNullSafe(y)
    else:
        same = x.isNull() & y.isNull()
    return F.coalesce(same, F.lit(False))


def latest_registrations(registrations: DataFrame) -> DataFrame:
    """(rule_id, outcome) as last registered, from (seq, rule_id, outcome); null ids and outcomes are ignored."""
    valid = registrations.where("rule_id is not null and outcome is not null")
    return valid.groupBy("rule_id").agg(F.max_by("outcome", "seq").alias("outcome"))


def if_match(rules: DataFrame, registrations: DataFrame) -> DataFrame:
    """rules (rule_id, ..) with `matched`: what the evaluator says, true where there is none or it fails.

    Outcomes are `true`, `false` or anything else, which stands for a failure."""
    of = latest_registrations(registrations).withColumnRenamed("rule_id", "__id")
    joined = rules.join(of, rules["rule_id"] == of["__id"], "left")
    return joined.select(*(rules[c] for c in rules.columns), F.coalesce(F.lower("outcome").try_cast("boolean"), F.lit(True)).alias("matched"))


def type_closure(edges: DataFrame) -> DataFrame:
    """(type, ancestor) with every type its own ancestor, from (type, supertype); cycles included.

    Semi-naive doubling: a round joins the pairs that the round before found to all that are known and keeps what is
    new, so pairs twice as far apart come in each round and no pair is derived again from pairs that were known. Rounds
    are checkpointed and end when one finds nothing, after the logarithm of the depth."""
    shared.checkpoints(edges.sparkSession)
    above = edges.select(F.col("type"), F.col("supertype").alias("ancestor")).where("ancestor is not null")
    names = above.select("type").union(above.select("ancestor")).distinct()
    found = above.where("type <> ancestor").distinct().checkpoint()
    known = found
    while not found.isEmpty():
        further = known.select(F.col("type").alias("ancestor"), F.col("ancestor").alias("top"))
        reached = found.join(further, "ancestor").select("type", F.col("top").alias("ancestor")).where("type <> ancestor").distinct()
        found = reached.join(known, ["type", "ancestor"], "left_anti").checkpoint()
        known = known.union(found)
    return known.union(names.select("type", F.col("type").alias("ancestor")))


def if_instance_of(values: DataFrame, closure: DataFrame, fqcn: str) -> DataFrame:
    """values (type, ..) with `is_instance`: whether fqcn is the value's type or an ancestor; false for null or an empty name."""
    of = closure.where(F.col("ancestor") == fqcn).select(F.col("type").alias("__type")).distinct()
    joined = values.join(of, values["type"] == of["__type"], "left")
    found = F.col("__type").isNotNull() | F.coalesce(values["type"] == fqcn, F.lit(False))
    return joined.select(*(values[c] for c in values.columns), (found & F.lit(bool(fqcn))).alias("is_instance"))
