"""Call traces: parsing, call pairing, sessions and counts, in batch and as a stream.

Functions that parse or count take batch and streaming DataFrames alike. Pairing by
window is for batch; pair_stream() keeps one stack per correlation id as state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from callweave.functions import shared
from callweave.streaming import pairing

#: The line forms.
FILE_LINE = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) \[(\w+)\] \[cid=([^\]]*)\] (.*)$"
CONSOLE_LINE = r"^(\S+(?: \S+)?) (TRACE|DEBUG|INFO|WARN|ERROR) +\[([^\]]*)\] (\S+) - (.*)$"
MESSAGES = {
    "call": r"^CALL cid=(\S*) method=(.*?) args=(\[.*\]) at=([^:]*):(\d+)$",
    "ret": r"^RET\s+cid=(\S*) method=(.*?) result=(.*)$",
    "throw": r"^THROW cid=(\S*) method=(.*?) ex=(\S+) msg=(.*)$",
    "enter": r"^→ (\S+) (\[.*\])$",
    "ok": r"^← (\S+) OK in (\d+) ms$",
    "failed": r"^✖ (\S+) failed in (\d+) ms: (.*?)(?: \(see stacktrace in console\))?$",
}
BEGINS = {"call": "CALL ", "ret": "RET", "throw": "THROW ", "enter": "→ ", "ok": "← ", "failed": "✖ "}


def parse(lines: DataFrame, keep: list[str] = ()) -> DataFrame:
    """lines (value, and columns to keep) as (ts, level, cid, phase, method, args, result, exception, message, source, elapsed_ms); other lines are left out.

    A correlation id of - or blank is null. Phases are enter, exit and failed."""
    v = F.col("value")
    # a pattern is met once: its groups come as one array, for which lines have no line end
    groups = lambda text, pattern, put: F.split(F.regexp_replace(text, pattern, put), "\n", -1)
    head = F.when(v.rlike(FILE_LINE), groups(v, FILE_LINE, "$1\n$2\n$3\n$4")).when(v.rlike(CONSOLE_LINE), groups(v, CONSOLE_LINE, "$1\n$2\n$3\n$5"))
    # what is exploded from an array of one is worked out there; a plain column would be copied into every use of it
    once = lambda c, name: F.explode_outer(F.array(c)).alias(name)
    headed = lines.select(*keep, "value", once(head, "__head"))
    b, found = F.col("__body"), None
    for name, pattern in MESSAGES.items():
        # a pattern is tried only where the body begins as it does
        told = groups(b, pattern, "\n".join([name, *(f"${k + 1}" for k in range(re.compile(pattern).groups))]))
        fits = b.startswith(BEGINS[name]) & b.rlike(pattern)
        found = F.when(fits, told) if found is None else found.when(fits, told)
    bodies = headed.select(*keep, "__head", F.coalesce(F.get("__head", F.lit(3)), v).alias("__body"))
    typed = bodies.select(*keep, "__head", once(found, "__g")).where("__g is not null")
    kind = F.get("__g", F.lit(0))
    got = lambda k, *names: F.when(kind.isin(*names), F.get("__g", F.lit(k)))
    known = lambda c: F.when(~F.trim(c).isin("", "-"), c)
    said = ("call", "ret", "throw")
    return typed.select(
        *keep,
        F.get("__head", F.lit(0)).try_cast("timestamp").alias("ts"),
        F.get("__head", F.lit(1)).alias("level"),
        known(F.coalesce(got(1, *said), F.get("__head", F.lit(2)))).alias("cid"),
        F.when(kind.isin("call", "enter"), "enter").when(kind.isin("ret", "ok"), "exit").otherwise("failed").alias("phase"),
        F.coalesce(got(2, *said), got(1, "enter", "ok", "failed")).alias("method"),
        F.coalesce(got(3, "call"), got(2, "enter")).alias("args"),
        got(3, "ret").alias("result"),
        got(3, "throw").alias("exception"),
        F.coalesce(got(4, "throw"), got(3, "failed")).alias("message"),
        F.when(kind == "call", F.concat_ws(":", F.get("__g", F.lit(4)), F.get("__g", F.lit(5)))).alias("source"),
        got(2, "ok", "failed").cast("bigint").alias("elapsed_ms"),
    )


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Trace lines of a folder as they arrive, parsed."""
    return parse(spark.readStream.text(path))


def suppressed(trace: DataFrame, methods: list[str]) -> DataFrame:
    """trace without the methods that opted out."""
    return trace.where(~F.coalesce(F.col("method").isin(list(methods)), F.lit(False)))


def selected(trace: DataFrame, packages: list[str]) -> DataFrame:
    """Calls of methods in the packages, wherever the name stands in the signature."""
    wanted = F.lit(False)
    for p in packages:
        wanted = wanted | F.contains("method", F.lit(p))
    return trace.where(wanted)


def _signed(phase: Column) -> Column:
    return F.when(phase == "enter", 1).otherwise(-1)


def pair_by_depth(trace: DataFrame, key: str = "cid", order: str = "seq") -> DataFrame:
    """trace's enters with the exit that ends each: (key, method, depth, enter_seq, exit_seq, phase), for traces without lost lines.

    The running depth changes by one a line, so at one key and depth enters and exits take turns: an enter's exit
    is the next line there, whatever its method. Exits without an enter are left out, enters without an exit have nulls."""
    by = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(_signed(F.col("phase"))).over(by)
    placed = trace.withColumn("depth", F.when(F.col("phase") == "enter", depth).otherwise(depth + 1))
    level = Window.partitionBy(key, "depth").orderBy(order)
    ended = placed.withColumns({"exit_seq": F.lead(order).over(level), "ended": F.lead("phase").over(level)})
    return ended.where("phase = 'enter'").select(key, "depth", "method", F.col(order).alias("enter_seq"), "exit_seq", F.col("ended").alias("phase"))


def pair_calls(trace: DataFrame, key: str = "cid", order: str = "seq") -> DataFrame:
    """trace's enters with the exit that ends each: (key, depth, method, enter_seq, exit_seq, phase), lost lines or not.

    An exit ends the last open call of its method and gives up the calls opened since; one without such a call is left
    out. Enters that nothing ends have nulls. Lines without a key are left out; of lines at one place any may be first.

    Lines are sorted into ranges of (key, order), so a key with most of the lines is spread over tasks. Only the first
    and the last key of a range can go on in another; of their lines a range settles those that no line elsewhere can
    change - calls from enter to exit with no unknown exit between - and what is left is settled in order by key."""
    shared.checkpoints(trace.sparkSession)
    of, at = (trace.schema[c].dataType.simpleString() for c in (key, order))
    lines = trace.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(order).alias("at"), "phase", "method")
    ranged = lines.repartitionByRange("key", "at").sortWithinPartitions("key", "at")
    told = ranged.mapInArrow(pairing.settle_ranges, pairing.TOLD.format(key=of, at=at)).checkpoint()
    left = told.where("kind = 'line'").select("key", "block", "n", F.col("enter_seq").alias("at"), "phase", "method")
    settled = left.repartition("key").sortWithinPartitions("key", "block", "n").mapInArrow(pairing.settle_rest, pairing.TOLD.format(key=of, at=at)).checkpoint()
    out = ["key", "depth", "method", "enter_seq", "exit_seq", "phase"]
    sizes = settled.where("kind = 'size'").select("key", "block", "n", F.col("depth").alias("below"))
    inside = told.where("kind = 'inside'").join(sizes, ["key", "block", "n"]).withColumn("depth", F.col("depth") + F.col("below"))
    pairs = told.where("kind = 'pair'").select(out).unionAll(settled.where("kind = 'pair'").select(out)).unionAll(inside.select(out))
    return pairs.withColumnRenamed("key", key)


def sessions(trace: DataFrame, key: str = "cid", gap: str = "30 minutes", time: str = "ts") -> DataFrame:
    """(key, start, end, lines) of stretches without a pause of `gap`."""
    return trace.groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count(F.lit(1)).alias("lines")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "lines")


def outcome_counts(trace: DataFrame, width: str = "1 minute", late: str | None = "10 minutes") -> DataFrame:
    """(start, method, phase, calls, total_ms) by window; late lines are kept for `late`, null if a watermark is set already."""
    rows = trace.withWatermark("ts", late) if trace.isStreaming and late else trace
    counted = rows.groupBy(F.window("ts", width).alias("w"), "method", "phase").agg(F.count(F.lit(1)).alias("calls"), F.sum("elapsed_ms").alias("total_ms"))
    return counted.select(F.col("w.start").alias("start"), "method", "phase", "calls", "total_ms")


def distinct_lines(trace: DataFrame, late: str = "10 minutes") -> DataFrame:
    """trace without lines that were delivered twice."""
    keys = ["ts", "cid", "phase", "method"]
    return trace.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if trace.isStreaming else trace.dropDuplicates(keys)


PAIRED = "cid string, method string, depth int, started long, ended long, phase string"
OPEN = "methods array<string>, times array<long>, latest long, held_times array<long>, held_phases array<string>, held_methods array<string>"


def pair_stream(trace: DataFrame, quiet_ms: int = 600_000, late: str = "10 minutes", wait: bool = False) -> DataFrame:
    """Finished calls of a stream, nested ones with their own durations; an id that is quiet for `quiet_ms` of event time is forgotten.

    Lines are taken as they come, in order of time within a delivery. With `wait` a line is held until the watermark
    has passed it, so lines that come in any order within `late` give the calls of the ordered trace. Pairs are those
    of pair_calls() on the same order."""

    def pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        methods, times, latest, *held = map(_plain, state.get) if state.exists else ([], [], 0, [], [], [])
        passed = state.getCurrentWatermarkMs() * 1000
        lines = list(zip(*held, strict=True))
        if not state.hasTimedOut:
            for rows in batches:
                lines += zip(*(rows[c].tolist() for c in ("at", "phase", "method")), strict=True)
        lines.sort(key=lambda x: x[0])
        ready = sum(x[0] <= passed for x in lines) if wait else len(lines)
        out = []
        for at, phase, method in lines[:ready]:
            if phase == "enter":
                methods.append(method)
                times.append(at)
            elif method in methods:
                k = len(methods) - 1 - methods[::-1].index(method)
                out.append((key[0], method, k + 1, times[k], at, phase))
                del methods[k:], times[k:]
            latest = max(latest, at)
        held = lines[ready:]
        if not held and state.hasTimedOut and latest + quiet_ms * 1000 <= passed:
            state.remove()
        else:
            state.update((methods, times, latest, *([x[c] for x in held] for c in range(3))))
            due = held[0][0] if held else latest + quiet_ms * 1000
            state.setTimeoutTimestamp(max(due // 1000 + 1, passed // 1000 + 1))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in PAIRED.split(", ")])

    keyed = trace.where("cid is not null and ts is not null").withWatermark("ts", late).select("cid", "ts", F.unix_micros("ts").alias("at"), "phase", "method").groupBy("cid")
    found = keyed.applyInPandasWithState(pair, PAIRED, OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    ms = F.round((F.col("ended") - F.col("started")) / 1000).cast("bigint")
    return found.select("cid", "method", "depth", F.timestamp_micros("started").alias("started"), F.timestamp_micros("ended").alias("ended"), "phase", ms.alias("elapsed_ms"))


def _plain(x):
    """A state's field as Python values."""
    return x if isinstance(x, int) else list(x)
