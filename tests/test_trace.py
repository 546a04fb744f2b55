import datetime as dt
import os
import random

import pandas as pd
import pytest

from callweave.streaming import pairing, trace

LINES = [
    "2024-01-01 10:00:00.000 [WARN] [cid=c1] → A.run(..) [1, x]",
    "2024-01-01 10:00:00.100 [WARN] [cid=c1] → B.go(..) []",
    "2024-01-01 10:00:00.250 [WARN] [cid=c1] ← B.go(..) OK in 150 ms",
    "2024-01-01 10:00:01.000 [ERROR] [cid=c1] ✖ A.run(..) failed in 0 ms: bad: news (see stacktrace in console)",
    "2024-01-01 10:00:02.000 [WARN] [cid=-] → C.x(..) []",
    "10:00:03 INFO  [] decision-trace - CALL cid=c2 method=public int p.T.m(int) args=[1] at=T.java:7",
    "RET  cid=c2 method=public int p.T.m(int) result=5",
    "THROW cid=c2 method=public int p.T.m(int) ex=java.lang.E msg=oh no",
    "unrelated",
]


def parsed(spark):
    return trace.parse(spark.createDataFrame([(x,) for x in LINES], "value string")).collect()


def test_parsing(spark):
    rows = parsed(spark)
    assert len(rows) == 8
    assert [(r["cid"], r["phase"], r["method"]) for r in rows[:5]] == [("c1", "enter", "A.run(..)"), ("c1", "enter", "B.go(..)"), ("c1", "exit", "B.go(..)"), ("c1", "failed", "A.run(..)"), (None, "enter", "C.x(..)")]
    assert rows[0]["ts"] == dt.datetime(2024, 1, 1, 10) and rows[0]["args"] == "[1, x]" and rows[2]["elapsed_ms"] == 150 and rows[3]["message"] == "bad: news"
    assert (rows[5]["cid"], rows[5]["method"], rows[5]["args"], rows[5]["source"]) == ("c2", "public int p.T.m(int)", "[1]", "T.java:7")
    assert rows[6]["result"] == "5" and (rows[7]["exception"], rows[7]["message"]) == ("java.lang.E", "oh no")


def test_pairing_nests_and_survives_stray_lines(spark):
    rows = [(1, "a", "x", "exit"), (2, "a", "f", "enter"), (3, "a", "g", "enter"), (4, "a", "g", "exit"), (5, "a", "h", "enter"), (6, "a", "h", "failed"), (7, "a", "f", "exit"), (8, "a", "open", "enter"), (1, "b", "f", "enter")]
    df = spark.createDataFrame(rows, "seq long, cid string, method string, phase string")
    got = {(r["cid"], r["method"]): (r["enter_seq"], r["exit_seq"], r["phase"]) for r in trace.pair_calls(df).collect()}
    assert got == {("a", "f"): (2, 7, "exit"), ("a", "g"): (3, 4, "exit"), ("a", "h"): (5, 6, "failed"), ("a", "open"): (8, None, None), ("b", "f"): (1, None, None)}


def test_filters(spark):
    df = spark.createDataFrame([("p.A.m", "1"), ("q.B.n", "2"), (None, "3")], "method string, cid string")
    assert [r["cid"] for r in trace.suppressed(df, ["q.B.n"]).collect()] == ["1", "3"]
    assert [r["cid"] for r in trace.selected(df, ["p."]).collect()] == ["1"]


def stream(spark, folder, lines):
    folder.mkdir()
    (folder / "1.log").write_text("\n".join(lines) + "\n")
    return trace.read_stream(spark, str(folder))


def finished(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    return df.sparkSession.table(name).collect()


def test_streaming_counts_and_duplicates(spark, tmp_path):
    lines = stream(spark, tmp_path / "a", LINES[:4] + LINES[:1])
    got = {(r["method"], r["phase"]): r["calls"] for r in finished(trace.outcome_counts(trace.distinct_lines(lines), late=None), "counts", "append")}
    assert got == {} or got == {("A.run(..)", "enter"): 1, ("B.go(..)", "enter"): 1, ("B.go(..)", "exit"): 1, ("A.run(..)", "failed"): 1}
    later = LINES[:4] + [LINES[0].replace("10:00:00.000", "11:30:00.000")]
    got = {(r["method"], r["phase"]): r["calls"] for r in finished(trace.outcome_counts(stream(spark, tmp_path / "b", later)), "later", "append")}
    assert got == {("A.run(..)", "enter"): 1, ("B.go(..)", "enter"): 1, ("B.go(..)", "exit"): 1, ("A.run(..)", "failed"): 1}


def test_streaming_pairs_keep_nested_durations(spark, tmp_path):
    got = {r["method"]: (r["depth"], r["phase"], r["elapsed_ms"]) for r in finished(trace.pair_stream(stream(spark, tmp_path / "a", LINES[:4])), "pairs", "append")}
    assert got == {"A.run(..)": (1, "failed", 1000), "B.go(..)": (2, "exit", 150)}


def test_sessions(spark):
    start = pd.Timestamp("2024-01-01")
    rows = [("u", (start + pd.Timedelta(minutes=m)).to_pydatetime()) for m in (0, 10, 39, 69, 100)]
    got = trace.sessions(spark.createDataFrame(rows, "cid string, ts timestamp")).orderBy("start").collect()
    assert [r["lines"] for r in got] == [4, 1]  # a pause of exactly the gap does not end a session


def lossy(seed, ids, lines, lost):
    """Nested calls of every id in order of seq, of which some lines are lost."""
    r = random.Random(seed)
    rows, seq = [], 0
    for cid in ids:
        stack = []
        for _ in range(lines):
            seq += 1
            if stack and r.random() < 0.5:
                row = (seq, cid, stack.pop(), r.choice(["exit", "failed"]))
            else:
                stack.append(f"m{r.randrange(4)}")
                row = (seq, cid, stack[-1], "enter")
            if r.random() >= lost:
                rows.append(row)
    return rows


def plain_pairs(rows):
    """(cid, enter_seq, exit_seq, phase, depth) by one stack a cid."""
    out = []
    for cid in {x[1] for x in rows}:
        stack = []
        for seq, _, method, phase in sorted(x for x in rows if x[1] == cid):
            names = [m for _, m in stack]
            if phase == "enter":
                stack.append((seq, method))
            elif method in names:
                k = len(names) - 1 - names[::-1].index(method)
                out += [(cid, s, None, None, k + 2 + j) for j, (s, _) in enumerate(stack[k + 1 :])]
                out.append((cid, stack[k][0], seq, phase, k + 1))
                del stack[k:]
        out += [(cid, s, None, None, j + 1) for j, (s, _) in enumerate(stack)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("lost,partitions", [(0.0, 3), (0.1, 7), (0.4, 16), (0.1, 1)])
def test_pairing_of_traces_with_lost_lines(spark, lost, partitions):
    rows = lossy(int(lost * 10) + partitions, ["hot"], 600, lost) + lossy(partitions, list("abcdefgh"), 12, lost) + [(10**6, None, "m1", "enter")]
    df = spark.createDataFrame(rows, "seq long, cid string, method string, phase string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trace.pair_calls(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(((r["cid"], r["enter_seq"], r["exit_seq"], r["phase"], r["depth"]) for r in got), key=repr) == plain_pairs([x for x in rows if x[1]])
    assert {(r["cid"], r["enter_seq"]): r["method"] for r in got} == {(c, s): m for s, c, m, p in rows if p == "enter" and c}


def test_a_lost_exit_does_not_pair_another_call(spark):
    df = spark.createDataFrame([(1, "c", "a", "enter"), (2, "c", "b", "enter"), (3, "c", "a", "exit")], "seq long, cid string, method string, phase string")
    assert sorted((r["method"], r["exit_seq"]) for r in trace.pair_calls(df).collect()) == [("a", 3), ("b", None)]


def test_stretches_in_a_row_pair_as_the_whole_does():
    for seed in range(60):
        rows = [(s, p, m) for s, _, m, p in lossy(seed, ["c"], 40, 0.25)]
        cuts = sorted(random.Random(seed).sample(range(1, len(rows)), 3))
        ended, rest = [], []
        for block, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
            settled, left = pairing.stretch(rows[a:b])
            ended += [(c.at, end, depth, block, line) for c, end, _, line, depth in settled]
            rest += [(block, n, *x) for n, x in enumerate(left)]
        lines = {(block, n): k for k, (block, n, *_) in enumerate(rest)}
        size, stack = {}, []
        for block, n, at, phase, method in rest:
            if phase == "enter":
                stack.append(method)
            elif phase != "begin" and method in stack:
                del stack[len(stack) - 1 - stack[::-1].index(method) :]
            size[lines[block, n]] = len(stack)
        got = [(at, end, depth + size[lines[block, line]]) for at, end, depth, block, line in ended]
        got += [(c.at, end, depth) for c, end, _, depth in pairing.whole([x[2:] for x in rest if x[3] != "begin"])]
        assert sorted(got, key=repr) == sorted(((c.at, end, depth) for c, end, _, depth in pairing.whole(rows)), key=repr)


def told(rows, start="2024-01-01"):
    """Lines of a trace file, a second apart by seq."""
    stamp = lambda s: (pd.Timestamp(start) + pd.Timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S.000")
    body = {"enter": "→ {} []", "exit": "← {} OK in 1 ms", "failed": "✖ {} failed in 1 ms: no"}
    return [f"{stamp(s)} [WARN] [cid={c}] {body[p].format(m)}" for s, c, m, p in rows]


def delivered(spark, folder, files, **options):
    folder.mkdir()
    for k, lines in enumerate(files):
        path = folder / f"{k:03d}.log"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    lines = trace.parse(spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder)))
    return {(r["cid"], r["started"], r["ended"], r["phase"], r["depth"]) for r in finished(trace.pair_stream(lines, **options), folder.name, "append")}


def test_late_deliveries_give_the_calls_of_the_ordered_trace(spark, tmp_path):
    rows = sorted(lossy(4, ["c1"], 80, 0.1) + [(s - 80, *x) for s, *x in lossy(4, ["", "c2"], 80, 0.1)[-70:]])
    r = random.Random(2)
    shuffled = sorted(rows, key=lambda x: x[0] + r.uniform(0, 20))
    last = [(10_000, "end", "m", "enter")], [(20_000, "end", "m", "exit")]
    files = [told(shuffled[k : k + 15]) for k in range(0, len(shuffled), 15)] + [told(x) for x in last]
    got = delivered(spark, tmp_path / "shuffled", files, late="30 seconds", wait=True)
    at = lambda s: (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    want = {(c, at(a), at(b), p, d) for c, a, b, p, d in plain_pairs(rows) if b}
    assert {x for x in got if x[0] != "end"} == want and len(want) > 30
    df = spark.createDataFrame(rows, "seq long, cid string, method string, phase string")
    batch = {(x["cid"], at(x["enter_seq"]), at(x["exit_seq"]), x["phase"], x["depth"]) for x in trace.pair_calls(df).where("exit_seq is not null").collect()}
    assert batch == want


def test_state_of_quiet_ids_is_forgotten(spark, tmp_path):
    files = [told(x) for x in ([(0, "a", "f", "enter")], [(5000, "b", "g", "enter")], [(10_000, "a", "f", "exit"), (10_001, "b", "g", "exit")])]
    got = delivered(spark, tmp_path / "quiet", files, late="1 second", quiet_ms=4_500_000, wait=True)
    assert {x[0] for x in got} <= {"b"}


@pytest.mark.parametrize("name", ["trace_parse", "trace_messages"])
def test_parsing_compiles(spark, name):
    from callweave import registry

    spark.conf.set("spark.sql.codegen.fallback", "false")  # code that is too long is an error, not interpreted
    try:
        found = registry.queries()[name](spark, "/root/testdata/sf0.001")
        assert found.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
        assert found.collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
