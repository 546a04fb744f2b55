"""Ranked lexical search: a blocked product of item-term multiplicities and term-document impacts.

1. Items become rows of a sparse matrix: how often each term stands in the item.
   They are cut into blocks of about ENTRIES entries; a block is what tasks hold.
2. One pass over the documents counts those with terms, all their terms, and for
   each term of the block the documents that hold it.
3. A second pass cuts each partition into blocks of documents. A block's matrix has
   a row a term: the documents that hold it and their int64 impacts. An item's scores
   are its terms' rows, times multiplicity, merged into one dense row (Gustavson).
4. Each task keeps its best documents of every item from block to block; tasks' lists
   are merged by item in two steps, first by parts of the tasks.

Scores are 64-bit integers; a document's length norm is worked out in Python integers
first, as 75 * length * documents may be longer.

Defined results: null and empty texts have no terms and are found by nothing; rows of
one item_id are one item that holds all their terms, a null item_id too; rows that
repeat a doc_id are ranked each by itself, those of equal score and id in any order;
documents without an id come after others of equal score; equal scores go by ascending
doc_id; items without a hit have no rows; other columns are ignored, whatever their
names; with no documents or no items the result is empty. doc_id is a whole number.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.llm._shared import materialise

#: Entries of an item block's matrix, on average: what each task holds of the items.
ENTRIES = 200_000
#: A block of documents ends at so many documents or entries.
BLOCK_DOCS, BLOCK_ENTRIES = 8_192, 2_000_000
#: Parts into which the tasks' lists are merged before they are merged by item alone.
PARTS = 64

#: ASCII letters and digits stay, capitals lower-cased, other ASCII parts terms; all bytes of other characters stay.
_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """A text's terms in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of items (item_id, text): the multiplicity matrix by entries."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text")):
                found = Counter(terms(text.as_py()))
                ids = batch.column("item_id").take(pa.array([k] * len(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["item_id", "term", "times"])

    kind = items.schema["item_id"].dataType.simpleString()
    entries = items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, term binary, times long")
    return entries.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


class _Items:
    """A block of items: ids and their type, vocabulary, and for each item its (term, multiplicity) pairs."""

    def __init__(self, entries: pa.Table, kind: str):
        self.kind = kind
        ids = entries.column("item_id").combine_chunks().dictionary_encode("encode")
        self.ids = ids.dictionary
        self.vocabulary = {t: k for k, t in enumerate(entries.column("term").unique().to_pylist())}
        self.rows: list[list[tuple[int, int]]] = [[] for _ in self.ids]
        for i, term, times in zip(ids.indices.to_pylist(), entries.column("term").to_pylist(), entries.column("times").to_pylist(), strict=True):
            self.rows[i].append((self.vocabulary[term], times))


def _statistics(docs: DataFrame, items: _Items) -> tuple[int, int, list[int]]:
    """Documents with terms, all their terms, and the documents that hold each term of the block."""
    vocabulary = items.vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, some, total = Counter(), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                found = terms(text.as_py())
                some, total = some + bool(found), total + len(found)
                holding.update(vocabulary.keys() & set(found))
        places = [-1, *(vocabulary[t] for t in holding)]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array([some, *holding.values()], pa.int64()), pa.array([total, *[0] * len(holding)], pa.int64())], ["place", "docs", "terms"])

    sums = docs.select("text").mapInArrow(count, "place long, docs long, terms long").groupBy("place").agg(F.sum("docs"), F.sum("terms")).toArrow()
    holding, (some, total) = [0] * len(vocabulary), (0, 0)
    for place, d, t in zip(*(c.to_pylist() for c in sums.columns), strict=True):
        if place < 0:
            some, total = d, t
        else:
            holding[place] = d
    return some, total, holding


class _Best:
    """The best documents of every item so far."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.held = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * items

    def take(self, item: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """Merge one item's dense row of a document block."""
        best, lacks, docs = self.held[item]
        least = best[-1] if len(best) == self.most else 1
        found = np.flatnonzero(scores >= least)
        if len(found) > self.most:
            line = np.partition(scores[found], -self.most)[-self.most]
            found = found[scores[found] >= line]
        if not len(found):
            return
        best, lacks, docs = np.concatenate([best, scores[found]]), np.concatenate([lacks, no_id[found]]), np.concatenate([docs, ids[found]])
        order = np.lexsort((docs, lacks, -best))[: self.most]
        self.held[item] = best[order], lacks[order], docs[order]


def _product(items: _Items, weights: np.ndarray, block: dict, best: _Best) -> None:
    """Scores of one block of documents: term rows of impacts, merged for each item."""
    doc, term, tf = (np.concatenate(block[c]) for c in ("doc", "term", "tf"))
    norm = np.array(block["norm"], np.int64)
    order = np.argsort(term, kind="stable")
    doc, term, tf = doc[order], term[order], tf[order]
    impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[doc]))
    starts = np.searchsorted(term, np.arange(len(weights) + 1))
    ids, no_id = np.array([i or 0 for i in block["id"]], np.int64), np.array([i is None for i in block["id"]])
    for i, row in enumerate(items.rows):
        scores = np.zeros(len(norm), np.int64)
        for t, times in row:
            a, b = starts[t], starts[t + 1]
            if a < b:
                # a document stands once in a term's row, so the sum by index is whole
                scores[doc[a:b]] += times * impact[a:b]
        best.take(i, scores, ids, no_id)


def _hits(docs: DataFrame, items: _Items, most: int) -> DataFrame:
    """(item_id, doc_id, score, part): each task's best documents of every item of a block."""
    some, total, holding = _statistics(docs, items)
    # the one place that is not integer: natural logarithm in doubles
    weights = np.array([math.floor(1000 * math.log((2 * some + 2) / (2 * h + 1))) for h in holding], np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items.rows), most)
        empty = lambda: {"doc": [], "term": [], "tf": [], "norm": [], "id": []}
        block, entries = empty(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms(text.as_py())
                known = [(items.vocabulary[t], n) for t, n in Counter(found).items() if t in items.vocabulary]
                if not known:
                    continue
                term, tf = np.array(known, np.int64).T
                block["doc"].append(np.full(len(known), len(block["id"])))
                block["term"].append(term)
                block["tf"].append(tf)
                block["norm"].append(100 - 75 + 75 * len(found) * some // total)
                block["id"].append(doc_id)
                entries += len(known)
                if len(block["id"]) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                    _product(items, weights, block, best)
                    block, entries = empty(), 0
        if block["id"]:
            _product(items, weights, block, best)
        part = TaskContext.get().partitionId() % PARTS
        for i, (scores, lacks, ids) in enumerate(best.held):
            if len(scores):
                columns = [items.ids.take(pa.array([i] * len(scores))), pa.array(ids, pa.int64(), mask=lacks), pa.array(scores), pa.array([part] * len(scores), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score", "part"])

    return docs.mapInArrow(search, f"item_id {items.kind}, doc_id long, score long, part int")


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `most` best documents with a score above 0."""
    kind = items.schema["item_id"].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    entries = materialise(item_terms(items), "items")
    blocks = max(1, -(-entries.count() // ENTRIES))
    hits = []
    for k in range(blocks):
        block = _Items(entries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow(), kind)
        hits.append(_hits(docs, block, most))
    found = reduce(DataFrame.unionAll, hits)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item_id", "part"], ["item_id"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)
    return found.select("item_id", "rank", "doc_id", "score")
