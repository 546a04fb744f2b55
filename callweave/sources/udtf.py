"""Scanners as SQL table functions, for LATERAL joins over any table of source texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from callweave.operators.events import EVENT_SCHEMA
from callweave.sources import java, kotlin, kotlin_tree

RULE_ROWS = "fqcn string, method string, rule_kind string, line int, condition_text string"


def scanner(scan: Callable[[str, str], Iterator[tuple]], schema: str):
    """A table function (text, file name) over a scanner; null texts give no rows."""

    class Scan:
        def eval(self, text: str, file_name: str):
            if text is not None:
                yield from scan(text, file_name or "")

    return udtf(Scan, returnType=schema)


def register(spark: SparkSession) -> None:
    """scan_kotlin, scan_java, legacy_kotlin_rules and regex_java_rules for SQL."""
    for name, scan, schema in (
        ("scan_kotlin", kotlin.scan, EVENT_SCHEMA),
        ("scan_java", java.scan, EVENT_SCHEMA),
        ("legacy_kotlin_rules", kotlin_tree.legacy_rules, RULE_ROWS),
        ("regex_java_rules", lambda text, _: java.regex_rules(text), RULE_ROWS),
    ):
        spark.udtf.register(name, scanner(scan, schema))
