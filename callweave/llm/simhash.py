"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Fingerprints that differ in
at most four bits differ in at most four bytes, so they share at least four positional
bytes; that is the guaranteed minimum.

1. Texts of equal fingerprints are one entry of the index.
2. Postings: of the four bytes shared by a pair, the first two stand among the first six
   positions (the first three among seven, the first four among eight). A posting is
   named by 2, 3 or 4 positions and their bytes, 15, 35 or 70 an entry; as many are
   taken as keep the average posting short.
3. Inside a posting the positional bytes shared by a pair are tallied; pairs with fewer
   than four are given up, the rest are verified on their bits. Pairs already in one
   component need no tally, and what comes out of a posting is a forest.
4. A posting of more than LIST entries is first dealt out at random into lists of that
   length. After the links found so far have become components, only entries outside
   the posting's largest component are compared with all others, block by block.
5. Links give components; a document's is the smallest doc_id in it.

Defined results: null, empty and blank texts have the fingerprint zero and are linked
like any other; rows that repeat a doc_id are each linked by their own text; rows
without a doc_id are linked with nothing and have a null component; other columns are
ignored, whatever their names; an empty table gives an empty result. doc_id is a whole
number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm._shared import materialise
from callweave.llm.neardup import BROADCAST_ROWS, smallest_reachable, split_words

WORDS, SEED = 4, 42
POSITIONS, MOST_BITS = 8, 4
#: Positional bytes that fingerprints within MOST_BITS share at least.
LEAST_SHARED = POSITIONS - MOST_BITS
#: Entries of a posting that are compared in one go, and how many a posting may have on average.
LIST, AVERAGE = 2_048, 64
#: Rows that a task gathers before it compares them.
GATHERED = 50_000


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of each shingle, repeats included; fewer words than WORDS are one shingle."""
    words = split_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(WORDS, len(words))
    cuts = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts], np.uint64)


def fingerprint(text: str | None) -> int:
    """Bits that are set in over half the hashes, as a signed 64-bit number."""
    h = shingle_hashes(text)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(h, max(1, len(h) // 65_536)):
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, print long")


def positions_for(entries: int) -> int:
    """Bytes that name a posting: two, or more where that many entries would make postings long."""
    return next((k for k in range(2, LEAST_SHARED) if entries <= AVERAGE * 256**k), LEAST_SHARED)


def postings(entries: DataFrame, named_by: int) -> DataFrame:
    """(posting, print): each entry (print) under all its postings."""
    byte = lambda p: F.shiftrightunsigned("print", 8 * p).bitwiseAND(255)
    names = []
    # the rest of the shared bytes must find room behind the last one of the name
    for number, places in enumerate(combinations(range(POSITIONS - LEAST_SHARED + named_by), named_by)):
        name = F.lit(number << 32)
        for k, p in enumerate(places):
            name = name + F.shiftleft(byte(p), 8 * k)
        names.append(name)
    return entries.select(F.explode(F.array(*names)).alias("posting"), "print")


def forest(ends: np.ndarray, prints: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of linked rows that join different labels, row k's list ending before ends[k].

    Rows are compared with the next, the one after and so on, all lists at once."""
    labels, out = labels.copy(), []
    rows, step = np.arange(len(prints)), 0
    starts = {}
    while True:
        step += 1
        rows = rows[ends[rows] > rows + step]
        if not len(rows):
            return out
        a = rows[labels[rows] != labels[rows + step]]
        apart = prints[a] ^ prints[a + step]
        shared = (apart.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(1)
        reach = shared >= LEAST_SHARED
        a, apart = a[reach], apart[reach]
        for i in a[np.bitwise_count(apart) <= MOST_BITS].tolist():
            j = i + step
            if labels[i] != labels[j]:
                end = int(ends[i])
                if end not in starts:
                    starts[end] = int(np.searchsorted(ends, end, "left"))
                own = labels[starts[end] : end]
                own[own == labels[j]] = labels[i]
                out.append((i, j))


def links(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b): linked prints of each list of dealt (keys, print, label) that join different labels."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        names = [table.column(k).to_numpy() for k in keys]
        new = np.flatnonzero(np.logical_or.reduce([n[1:] != n[:-1] for n in names])) + 1
        bounds = np.concatenate([[0], new, [table.num_rows]])
        ends = np.repeat(bounds[1:], np.diff(bounds))
        prints = table.column("print").to_numpy()
        found = np.array(forest(ends, prints.view(np.uint64), table.column("label").to_numpy()), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(prints[found[:, 0]]), pa.array(prints[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= GATHERED:
                table = pa.Table.from_batches(held).combine_chunks()
                last = np.logical_and.reduce([table.column(k).to_numpy() == table.column(k)[-1].as_py() for k in keys])
                cut = int(np.argmax(last))  # the last list may go on in the next batch
                if cut:
                    yield compared(table.slice(0, cut))
                    table = table.slice(cut)
                held, n = table.to_batches(), table.num_rows
        if n:
            yield compared(pa.Table.from_batches(held).combine_chunks())

    ordered = dealt.select(*keys, "print", "label").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _small(rows: DataFrame) -> DataFrame:
    """A stored table, broadcast where its number of rows allows it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of docs (doc_id, text)."""
    printed = materialise(fingerprints(docs), "fingerprints")
    entries = materialise(printed.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("least")), "entries")
    posted = postings(entries, positions_for(entries.count()))

    long = materialise(posted.groupBy("posting").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > LIST), "long-postings")
    several = not long.isEmpty()
    lists = posted.withColumn("list", F.lit(0))
    if several:
        lists = posted.join(_small(long), "posting", "left").withColumn("list", F.when(F.col("total").isNull(), 0).otherwise(F.pmod(F.xxhash64("print"), F.ceil(F.col("total") / LIST))).cast("int"))
    first = materialise(smallest_reachable(links(lists.withColumn("label", F.col("print")), ["posting", "list"])), "first")
    joined = first
    if several:
        again = links(_between(posted, long, first), ["posting", "p", "q"])
        of = first.toDF("print", "component")
        ends = again.join(of.toDF("a", "ca"), "a", "left").join(of.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        second = materialise(smallest_reachable(ends), "second").toDF("component", "whole")
        loose = second.join(of, second["component"] == of["print"], "left_anti").select("component", "whole")
        joined = of.join(second, "component", "left").select("print", F.coalesce("whole", "component").alias("component")).union(loose)
    labels = joined.toDF("print", "component").join(entries, "print")
    least = labels.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = labels.join(least, "component").select("print", "smallest")
    # what repeats a print without a link to others has its component from the entry
    found = materialise(entries.join(linked, "print", "left").select("print", F.coalesce("smallest", "least").alias("smallest")), "found")
    out = printed.join(found, "print", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("smallest")).alias("component_id"))


def _between(posted: DataFrame, long: DataFrame, first: DataFrame) -> DataFrame:
    """(posting, p, q, print, label): of long postings that hold several components, blocks of what is outside the largest one against blocks of all."""
    mine = posted.join(_small(long), "posting").join(first.toDF("print", "component"), "print", "left")
    mine = materialise(mine.select("posting", "print", F.coalesce("component", "print").alias("label")), "long-members")
    sizes = mine.groupBy("posting", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("posting").agg(F.max(F.struct("size", "label")).alias("main"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = materialise(mixed.select("posting", F.col("main.label").alias("main"), "total", (F.col("total") - F.col("main.size")).alias("others")), "mixed")
    rows = mine.join(_small(mixed), "posting")
    blocks = lambda n: F.ceil(F.col(n) / LIST).cast("int")
    place = lambda n: F.pmod(F.xxhash64("print"), blocks(n)).cast("int")
    outside = rows.where("label <> main").select("posting", place("others").alias("p"), F.explode(F.sequence(F.lit(0), blocks("total") - 1)).alias("q"), "print", "label")
    every = rows.select("posting", F.explode(F.sequence(F.lit(0), blocks("others") - 1)).alias("p"), place("total").alias("q"), "print", "label")
    return outside.union(every)
