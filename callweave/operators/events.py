"""Operators over the event table: filters, order, first-seen and orphan flags, unions.

An event is (language, fqcn, method, signature, kind, line, condition_text) with a
scan_seq that keeps the order in which scanners gave it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EVENT_SCHEMA = "language string, fqcn string, method string, signature string, kind string, line int, condition_text string"
METHOD = ("language", "fqcn", "method", "signature")
ORDER = ("language", "fqcn", "method", "line", "kind", "scan_seq")


def any_prefix(name: Column, prefixes: list[str]) -> Column:
    """Whether a name starts with one of the prefixes; no prefix allows everything."""
    return reduce(lambda a, b: a | b, (F.startswith(name, F.lit(p)) for p in prefixes)) if prefixes else F.lit(True)


def merged_prefixes(prefixes: list[str], legacy: str | None = None) -> list[str]:
    """The prefix list and the single legacy prefix, blanks dropped, repeats kept."""
    return [p for p in (*prefixes, legacy or "") if p.strip()]


def by_package(df: DataFrame, include: list[str], exclude: list[str] = (), column: str = "package") -> DataFrame:
    """Rows whose package is included and not excluded; a null package is the root package."""
    name = F.coalesce(F.col(column), F.lit(""))
    out = df.where(any_prefix(name, list(include)))
    return out.where(~any_prefix(name, list(exclude))) if exclude else out


def usable(events: DataFrame, prefixes: list[str] = ()) -> DataFrame:
    """Events with a known line, in a class under one of the prefixes."""
    return events.where("line >= 0").where(any_prefix(F.col("fqcn"), list(prefixes)))


def placed(events: DataFrame, by: tuple[str, ...] = ORDER[:2]) -> DataFrame:
    """events with their place, from 1, in the stable order of rule generation within each class.

    Signature is no key, ties keep scan order. Places within a class and not over all events, so no task sorts them all."""
    order = Window.partitionBy(*by).orderBy(*(c for c in ORDER if c not in by))
    return events.withColumn("place", F.row_number().over(order).cast("bigint"))


def with_method_flags(events: DataFrame) -> DataFrame:
    """events with is_first, the first event of its method, and is_orphan, a Kotlin branch of a method without a switch.

    Both windows share one partitioning by method, so there is one shuffle."""
    method = Window.partitionBy(*METHOD)
    first = F.row_number().over(method.orderBy("line", "kind", "scan_seq")) == 1
    has_switch = F.max((F.col("language") == "kotlin") & (F.col("kind") == "switch")).over(method)
    orphan = (F.col("language") == "kotlin") & (F.col("kind") == "when-branch") & ~has_switch
    return events.withColumns({"is_first": first, "is_orphan": F.coalesce(orphan, F.lit(False))})


def first_seen(events: DataFrame) -> DataFrame:
    """The first event of each method."""
    return with_method_flags(events).where("is_first").drop("is_first", "is_orphan")


def methods_with_switch(events: DataFrame) -> DataFrame:
    return events.where("language = 'kotlin' and kind = 'switch'").select(*METHOD).distinct()


def orphan_branches(events: DataFrame) -> DataFrame:
    """Kotlin branches in methods that have no switch event, by anti-join."""
    branches = events.where("language = 'kotlin' and kind = 'when-branch'")
    return branches.join(methods_with_switch(events), list(METHOD), "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    """Java events before Kotlin events, or any other frames in the order given, repeats kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def missing_methods(found: DataFrame, seen: DataFrame) -> DataFrame:
    """(fqcn, method) of found that no event was seen for."""
    return found.select("fqcn", "method").distinct().join(seen.select("fqcn", "method").distinct(), ["fqcn", "method"], "left_anti")


def tracked_writes(events: DataFrame, names: list[str]) -> DataFrame:
    """Writes to the named variables."""
    return events.where((F.col("kind") == "write") & F.col("condition_text").isin(list(names)))


def brace_depth(lines: DataFrame) -> DataFrame:
    """lines (path, n, line) with depth, the braces open after each line."""
    delta = lambda c: F.length("line") - F.length(F.replace(F.col("line"), F.lit(c), F.lit("")))
    so_far = Window.partitionBy("path").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("depth", F.sum(delta("{") - delta("}")).over(so_far))
