"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Pieces longer than a third of the capacity are matched greedily, the largest with
the largest that fits, so a sequence holds at most two of them; smaller pieces
then go, largest first, into the smallest remaining gap that holds them.

The packing is decided on the histogram of piece lengths: at most `capacity`
counts reach the driver, however many documents there are. Sequences that look
alike are handled as ranges, so the plan is a table of (length, first rank,
count, first sequence, offset) whose size depends on the capacity only. Pieces
get their rank within their length from per-salt counts and join the plan; no
task ever holds all pieces of a common length.

Defined results: null and empty texts are one closing id; repeated rows are
packed once each; null doc_ids are packed like others; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.llm._shared import materialise
from callweave.llm.tokens import token_ids

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces of one length and salt that one window group should hold.
SALT_ROWS = 10_000
PIECES = "piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which takes the remainder."""
    first = (n - 1) % capacity + 1 if n else 0
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def document_pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs (doc_id, text)."""

    def pieces(batches):
        for batch in batches:
            out = {k: [] for k in ("row", "piece", "start", "length", "ids_crc32")}
            for row, text in enumerate(batch.column("text")):
                ids = np.append(token_ids(text.as_py()), np.uint32(CLOSING_ID)).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    for name, x in zip(out, (row, k, start, n, zlib.crc32(ids[start : start + n].tobytes())), strict=True):
                        out[name].append(x)
            ids = batch.column("doc_id").take(pa.array(out.pop("row"), pa.int64()))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], ["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(pieces, f"doc_id {kind}, {PIECES}")


class _Gaps:
    """Open sequences as ranges [first, first + n) under their common gap."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.ranges:
                insort(self.sizes, gap)
                self.ranges[gap] = []
            self.ranges[gap].append((first, n))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """The last range of the smallest gap that holds `least`, removed: (gap, first, n)."""
        k = bisect_left(self.sizes, least)
        if k == len(self.sizes):
            return None
        gap = self.sizes[k]
        first, n = self.ranges[gap].pop()
        if not self.ranges[gap]:
            del self.ranges[gap]
            self.sizes.pop(k)
        return gap, first, n


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) rows that place every piece of the histogram."""
    left = {k: n for k, n in histogram.items() if n}
    used = dict.fromkeys(left, 0)
    gaps, plan, made = _Gaps(), [], 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        plan.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def fill(length: int, gap: int, first: int, n: int) -> None:
        """Put pieces of a length into n sequences of a gap, each as full as it gets, until none are left."""
        each = gap // length
        whole = min(n, left[length] // each)
        for layer in range(each if whole else 0):
            place(length, whole, first, capacity - gap + layer * length)
        gaps.add(gap - each * length, first, whole)
        rest = min(left[length], each - 1) if whole < n else 0
        for layer in range(rest):
            place(length, 1, first + whole, capacity - gap + layer * length)
        if whole < n:
            gaps.add(gap - rest * length, first + whole, 1)
            gaps.add(gap, first + whole + 1, n - whole - 1)

    large = sorted(k for k in left if 3 * k > capacity)
    for length in reversed(large):
        while left[length]:
            k = bisect_left(large, min(length, capacity - length) + 1) - 1
            while k >= 0 and left[large[k]] < (2 if large[k] == length else 1):
                k -= 1
            if k < 0:
                n = left[length]
                place(length, n, made, 0)
                gaps.add(capacity - length, made, n)
            else:
                other = large[k]
                n = left[length] // 2 if other == length else min(left[length], left[other])
                place(length, n, made, 0)
                place(other, n, made, length)
                gaps.add(capacity - length - other, made, n)
            made += n
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            found = gaps.take(length)
            if found is None:
                n = -(-left[length] // (capacity // length))
                found = (capacity, made, n)
                made += n
            fill(length, *found)
    return plan


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of docs (doc_id, text)."""
    spark = docs.sparkSession
    pieces = materialise(document_pieces(docs, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = packing_plan(histogram, capacity)
    columns = [pa.array([row[k] for row in plan], pa.int64()) for k in range(5)]
    placed = spark.createDataFrame(pa.table(columns, ["of", "from_rank", "n", "first", "offset"]))

    salts = max(16, sum(histogram.values()) // SALT_ROWS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("within", within).join(starts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within") - 1)
    here = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("from_rank") + F.col("n"))
    # the plan has a bound in the capacity, whatever the corpus; joined by a shuffle, a common length would be one task
    out = ranked.join(F.broadcast(placed), here)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - F.col("from_rank")).alias("sequence_id"), "offset")
