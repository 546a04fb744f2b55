"""Source divergence audit: term counts of each source of a language, by mergeable radix tries.

1. Each partition counts its terms in one byte trie a language; a leaf has the number
   of documents that hold the term and a counter for each source. Tries beyond LEAVES
   leaves are written out and new ones begun, as tries of any split of the rows merge
   to the same sums.
2. Leaves are dealt by ranges of (language, term bytes), so a prefix with any number of
   terms is cut where its leaves are, and merged into one trie a range. Its traversal
   in UTF-8 order gives the kept terms.
3. A second traversal turns counts into probabilities and streams, block by block, sums
   of pairs of sources and each group's best terms; terms of equal value keep the order
   of the traversal. Tasks' sums and lists are then merged by group.

All values are whole numbers: p = 1 + floor(10^9 (count + 1) / (N + V)) is worked out in
two divisions, exact up to 2.8 * 10^14 terms a language. A sum of f is at most
(10^9 + V)^2 + 10^9 + V, below 2^63 up to V = 2 * 10^9 kept terms.

Defined results: null text, language and source are ''; a group without kept terms has
N = 0; in a language without kept terms pairs have the value 0 and there are no term
rows; a language of one source has no pairs; repeated rows count each; other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.llm._shared import materialise

#: A term is kept if so many documents of the language hold it.
LEAST_DOCS = 3
#: Term rows of a group.
MOST = 200
#: Leaves that a task's tries hold before they are written out, or that are merged at a time.
LEAVES = 300_000
#: Counters of (leaf, source) that such tries hold at most.
COUNTERS = 2_000_000
#: Bytes and number of texts whose terms are cut at a time, and pieces of a longer text that are summed at a time.
PIECE, TEXTS, PIECES = 8 << 20, 8192, 8
#: Groups whose names and totals tasks hold at a time; languages are taken in so many turns.
GROUPS = 200_000
#: Cells of a block's matrix of terms by sources.
CELLS = 1 << 20
#: Parts into which the tasks' lists are merged before they are merged by group alone.
PARTS = 64
UNIT = 1_000_000_000

#: Terms are runs of ASCII letters, lower-cased, and other characters beyond ASCII, in UTF-8; all else becomes blank.
_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
ENTRY = "lang string, term binary, docs long, sources array<string>, counts array<long>"
_ENTRY = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


class Trie:
    """A radix trie over distinct terms, as bytes; a leaf is a term's number.

    Its upper levels, which nearly all terms share, are one: STEM bytes, or a shorter term, name the nodes below the
    root. A node of at most BUCKET leaves is the list of their numbers in the order of the terms. One of more is
    (label, number of the term that ends with the label or None, nodes by next byte)."""

    STEM = 3
    BUCKET = 64

    def __init__(self, terms: Iterable[bytes]):
        self.terms = list(terms)
        self.stems: dict[bytes, list | tuple] = {}
        below, end = defaultdict(list), self.STEM
        for number, term in enumerate(self.terms):
            below[term[:end]].append(number)
        for stem, numbers in below.items():
            self._grow(self.stems, stem, numbers)

    def _grow(self, nodes: dict, name: bytes | int, numbers: list[int]) -> None:
        """Put the node over these leaves, which share the path to it, at nodes[name]."""
        term = self.terms.__getitem__
        stack = [(nodes, name, numbers, len(name))]
        while stack:
            nodes, name, numbers, at = stack.pop()
            if len(numbers) <= self.BUCKET:
                numbers.sort(key=term)
                nodes[name] = numbers
                continue
            first, last = min(map(term, numbers)), max(map(term, numbers))
            end = at
            while end < len(first) and first[end] == last[end]:
                end += 1
            own, below = None, defaultdict(list)
            for k in numbers:
                if len(self.terms[k]) == end:
                    own = k
                else:
                    below[self.terms[k][end]].append(k)
            nodes[name] = (first[at:end], own, children := {})
            stack += [(children, byte, of, end + 1) for byte, of in below.items()]

    def order(self) -> list[int]:
        """The leaves in the order of the terms' bytes."""
        out: list[int] = []
        stack = [self.stems[stem] for stem in sorted(self.stems, reverse=True)]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                out += node
                continue
            _, own, children = node
            if own is not None:
                out.append(own)
            stack += [children[byte] for byte in sorted(children, reverse=True)]
        return out

    def walk(self) -> Iterator[tuple[bytes, int]]:
        """(term, number) in the order of the terms' bytes."""
        return ((self.terms[k], k) for k in self.order())


def _leaves(lang: str, trie: Trie, docs: np.ndarray, leaf: np.ndarray, source: np.ndarray, count: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """A trie's leaves in order, from documents by leaf and counts by (leaf, source)."""
    order = np.array(trie.order())
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = place[leaf]
    by_place = np.argsort(at, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(order)))])
    lists = lambda values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    return _batch([pa.array([lang] * len(order), pa.string()), pa.array(trie.terms, pa.binary()).take(pa.array(order)), pa.array(docs[order]), lists(names.take(pa.array(source[by_place]))), lists(pa.array(count[by_place]))])


def _batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)


class Tally:
    """Counts of terms by group: rows (group, term, documents, occurrences), group and term by number, each pair once."""

    def __init__(self, terms: pa.Array, group: np.ndarray, term: np.ndarray, docs: np.ndarray, count: np.ndarray):
        self.terms, self.group, self.term, self.docs, self.count = terms, group, term, docs, count

    @classmethod
    def of(cls, texts: list[bytes | None], group: np.ndarray) -> Tally:
        """Of whole texts, whose groups are given; their terms are cut and numbered at once."""
        data = b" ".join(t or b"" for t in texts).translate(_TERMS)
        letter = np.frombuffer(b" " + data + b" ", np.uint8) != 32
        edges = np.flatnonzero(letter[1:] != letter[:-1])
        begins, lengths = edges[::2], edges[1::2] - edges[::2]
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        kept = np.frombuffer(data, np.uint8)[letter[1:-1]]
        found = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(kept)]).dictionary_encode()
        stops = np.cumsum([len(t or b"") + 1 for t in texts])
        doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begins, stops), prepend=0))
        n = max(1, len(found.dictionary))
        # below 2^63, as texts are at most TEXTS and a batch, and their bytes PIECE unless one is longer
        key = np.sort((group[doc] * n + found.indices.to_numpy()) * len(texts) + doc)
        pair = key // len(texts)
        new_pair = np.flatnonzero(np.diff(pair, prepend=-1))
        new_doc = np.diff(key, prepend=-1) != 0
        docs = np.add.reduceat(new_doc, new_pair, dtype=np.int64) if len(key) else new_pair
        return cls(found.dictionary, pair[new_pair] // n, pair[new_pair] % n, docs, np.diff(new_pair, append=len(key)))

    @classmethod
    def long(cls, text: bytes, group: int) -> Tally:
        """Of one text of any length, piece by piece; a piece ends where a term does."""
        at, parts, blank = 0, [], text.translate(_TERMS)
        while at < len(text):
            end = blank.find(b" ", at + PIECE)
            end = len(text) if end < 0 else end
            parts.append(cls.of([text[at:end]], np.array([group])))
            if len(parts) == PIECES:
                parts = [cls.sum(parts)]
            at = end
        out = cls.sum(parts)
        out.docs = np.ones(len(out.docs), np.int64)
        return out

    @classmethod
    def sum(cls, parts: list[Tally]) -> Tally:
        if len(parts) == 1:
            return parts[0]
        every = pa.chunked_array([p.terms for p in parts], pa.binary()).combine_chunks().dictionary_encode()
        number = every.indices.to_numpy()
        starts = np.cumsum([0] + [len(p.terms) for p in parts])
        group, docs, count = (np.concatenate([getattr(p, x) for p in parts]) for x in ("group", "docs", "count"))
        n = max(1, len(every.dictionary))
        key = group * n + np.concatenate([number[p.term + start] for p, start in zip(parts, starts, strict=False)])
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        add = lambda x: np.add.reduceat(x[order], new) if len(new) else x
        return cls(every.dictionary, key[new] // n, key[new] % n, add(docs), add(count))


def counted(docs: DataFrame) -> DataFrame:
    """Leaves of the partitions' tries over docs (text, lang, source); each group also has a row without a term.

    Repeats of a term are counted before it goes into the trie, so that it goes there once."""

    def grown(tally: Tally, groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        langs = np.array([lang for lang, _ in groups], object)
        for lang in sorted({groups[g][0] for g in np.unique(tally.group).tolist()}):
            own = (langs == lang)[tally.group]
            mine, source = np.unique(tally.group[own], return_inverse=True)
            number, leaf = np.unique(tally.term[own], return_inverse=True)
            held = np.zeros(len(number), np.int64)
            np.add.at(held, leaf, tally.docs[own])
            yield _leaves(lang, Trie(tally.terms.take(pa.array(number)).to_pylist()), held, leaf, source, tally.count[own], pa.array([groups[g][1] for g in mine.tolist()], pa.string()))

    def tallies(batches: Iterator[pa.RecordBatch], groups: dict[tuple[str, str], int]) -> Iterator[Tally]:
        texts, group, size = [], [], 0
        for batch in batches:
            whole = batch.column("text").cast(pa.binary())
            for text, *named in zip(whole.to_pylist(), *(batch.column(c).to_pylist() for c in ("lang", "source")), strict=True):
                g = groups.setdefault(tuple(named), len(groups))
                if text and len(text) > PIECE:
                    yield Tally.long(text, g)
                    continue
                texts.append(text)
                group.append(g)
                size += len(text or b"")
                if size > PIECE or len(texts) >= TEXTS:
                    yield Tally.of(texts, np.array(group))
                    texts, group, size = [], [], 0
        if texts:
            yield Tally.of(texts, np.array(group))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        parts: list[Tally] = []
        summed = 0
        for part in tallies(batches, groups):
            parts.append(part)
            if sum(len(p.term) for p in parts) > max(LEAVES, 2 * summed):
                parts = [Tally.sum(parts)]
                summed = len(parts[0].term)
                if len(parts[0].terms) > LEAVES or summed > COUNTERS:
                    yield from grown(parts[0], list(groups))
                    parts, summed = [], 0
        if parts:
            yield from grown(Tally.sum(parts), list(groups))
        if groups:
            langs, sources = zip(*sorted(groups), strict=True)
            yield _batch([langs, [None] * len(groups), [0] * len(groups), [[s] for s in sources], [[0]] * len(groups)])

    named = docs.select("text", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    return named.mapInArrow(count, ENTRY)


def merged(leaves: DataFrame) -> DataFrame:
    """The kept terms' leaves, merged by ranges of (lang, term)."""

    def summed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Tries of the languages in rows, whose leaves come in order and are all there."""
        new = np.concatenate([[True], ~np.asarray(pc.and_(*(pc.equal(rows.column(c)[1:], rows.column(c)[:-1]) for c in ("lang", "term"))))])
        firsts = np.flatnonzero(new)
        docs = np.add.reduceat(rows.column("docs").to_numpy(), firsts)
        keep = docs >= LEAST_DOCS
        group = np.cumsum(new) - 1
        rows, group, firsts, docs = rows.filter(pa.array(keep[group])), (np.cumsum(keep) - 1)[group[keep[group]]], firsts[keep], docs[keep]
        if not len(firsts):
            return
        rows = rows.combine_chunks()
        source = rows.column("sources").chunk(0).flatten().dictionary_encode()
        names, count = source.dictionary, rows.column("counts").chunk(0).flatten().to_numpy()
        of = np.repeat(group, rows.column("counts").chunk(0).value_lengths().to_numpy())
        pairs, where = np.unique(of * len(names) + source.indices.to_numpy(), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, where, count)
        first_rows = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        langs, terms = (rows.column(c).take(pa.array(first_rows)).to_pylist() for c in ("lang", "term"))
        leaf, by = pairs // len(names), pairs % len(names)
        begin = 0
        for lang, same in groupby(langs):
            end = begin + sum(1 for _ in same)
            own = (leaf >= begin) & (leaf < end)
            yield _leaves(lang, Trie(terms[begin:end]), docs[begin:end], leaf[own] - begin, by[own], total[own], names)
            begin = end

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= LEAVES:
                rows = pa.Table.from_batches(held)
                same = pc.and_(*(pc.equal(rows.column(c), rows.column(c)[-1]) for c in ("lang", "term")))
                cut = int(np.argmax(np.asarray(same)))  # the last term may go on in the next batch
                if cut:
                    yield from summed(rows.slice(0, cut))
                    rows = rows.slice(cut)
                held, n = rows.to_batches(), rows.num_rows
        if n:
            yield from summed(pa.Table.from_batches(held))

    return leaves.where("term is not null").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, ENTRY)


def _probability(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT (count + 1) / total), without products of more than 64 bits."""
    whole, left = np.divmod(count + 1, total)
    first, left = np.divmod(left * 31_250, total)
    return 1 + whole * UNIT + first * 32_000 + left * 32_000 // total


def _traverse(kept: DataFrame, names: dict[str, tuple[list[str], list[int], int]]) -> DataFrame:
    """(part, lang, source, item, value, dealt): sums of pairs and best terms of each task.

    names has for each language its sources, their totals and the number of kept terms."""

    def row(part: str, lang: str, source: str, items: list[str], values, dealt: int) -> pa.RecordBatch:
        n = len(items)
        columns = [pa.array([x] * n, pa.string()) for x in (part, lang, source)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(items, pa.string()), pa.array(values, pa.int64()), pa.array([dealt] * n, pa.int32())], ["part", "lang", "source", "item", "value", "dealt"])

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = TaskContext.get().partitionId() % PARTS
        best: dict[str, list[tuple[np.ndarray, list[bytes]]]] = {}
        sums: dict[str, np.ndarray] = {}

        def block(lang: str, rows: list[pa.RecordBatch]) -> None:
            sources, totals, kept_terms = names[lang]
            table = pa.Table.from_batches(rows).combine_chunks()
            own, counters = (table.column(c).chunk(0) for c in ("sources", "counts"))
            place = pc.index_in(own.flatten(), pa.array(sources, pa.string())).to_numpy()
            count = np.zeros((table.num_rows, len(sources)), np.int64)
            count[np.repeat(np.arange(table.num_rows), own.value_lengths().to_numpy()), place] = counters.flatten().to_numpy()
            terms = table.column("term").to_pylist()
            p = _probability(count, np.array(totals, np.int64) + kept_terms)
            q = _probability(count.sum(1), sum(totals) + kept_terms)
            pairs = sums.setdefault(lang, np.zeros((len(sources), len(sources)), np.int64))
            lists = best.setdefault(lang, [(np.zeros(0, np.int64), [])] * len(sources))
            for g in range(len(sources)):
                away = p[:, [g]] - p
                pairs[g] += (away * away // p).sum(0)
                found = np.flatnonzero((count[:, g] > 0) & (p[:, g] > q))
                if len(found):
                    over = p[found, g] - q[found]
                    values, words = lists[g]
                    values, words = np.concatenate([values, over * over // q[found]]), words + [terms[k] for k in found]
                    top = np.argsort(-values, kind="stable")[:MOST]  # stable: ties stay in UTF-8 order
                    lists[g] = values[top], [words[k] for k in top]

        def told(lang: str, whole: bool) -> Iterator[pa.RecordBatch]:
            sources = names[lang][0]
            if whole or len(sources) ** 2 > CELLS:
                by = sums.pop(lang)
                for g, s in enumerate(sources):
                    others = [h for h in range(len(sources)) if h != g]
                    yield row("pair", lang, s, [sources[h] for h in others], by[g, others], dealt)
            if whole:
                for s, (values, words) in zip(sources, best.pop(lang), strict=True):
                    yield row("term", lang, s, [w.decode("utf-8", "surrogatepass") for w in words], values, dealt)

        now, rows, n = None, [], 0
        for batch in batches:
            at = 0
            for lang, same in groupby(batch.column("lang").to_pylist()):
                stop = at + sum(1 for _ in same)
                while at < stop:
                    if rows and (lang != now or n * len(names[now][0]) >= CELLS):
                        block(now, rows)
                        yield from told(now, lang != now)
                        rows, n = [], 0
                    now = lang
                    some = min(stop - at, -(-CELLS // len(names[now][0])) - n)
                    rows.append(batch.slice(at, some))
                    at, n = at + some, n + some
        if rows:
            block(now, rows)
            yield from told(now, True)

    ordered = kept.sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(traverse, "part string, lang string, source string, item string, value long, dealt int")


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) over docs (text, lang, source)."""
    leaves = materialise(counted(docs), "leaves")
    kept = materialise(merged(leaves), "kept-terms")
    groups = leaves.where("term is null").select("lang", F.col("sources")[0].alias("source")).distinct()
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["n", "terms"])
    groups = materialise(groups, "groups")
    turns = max(1, -(-groups.count() // GROUPS))
    turn = F.pmod(F.xxhash64("lang"), F.lit(turns))
    told = []
    for k in range(turns):
        names: dict[str, tuple[list, list, int]] = {}
        for lang, source, n, v in zip(*(c.to_pylist() for c in groups.where(turn == k).where("terms > 0").orderBy("lang", "source").toArrow().columns), strict=True):
            sources, ns, _ = names.setdefault(lang, ([], [], v))
            sources.append(source)
            ns.append(n)
        told.append(_traverse(kept.where(turn == k), names))
    told = materialise(reduce(DataFrame.unionAll, told), "told")

    pairs = told.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bare = groups.where("terms = 0").select("lang", "source")
    zero = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.unionByName(zero.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value")))
    best, order = told.where("part = 'term'"), [F.col("value").desc(), F.col("item")]
    ranked = lambda rows, *keys: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    best = ranked(best, "lang", "source", "dealt").where(F.col("rank") <= MOST)
    best = ranked(best, "lang", "source").where(F.col("rank") <= MOST)
    out = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(pairs, "lang", "source").select(out).unionAll(best.select(out))
