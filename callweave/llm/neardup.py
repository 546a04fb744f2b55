"""Near-duplicate documents by banded MinHash with sequential Bayesian verification.

1. Each text becomes a set of hashed word shingles, a signature of bands * rows
   minima and a key of its word sequence. Texts with equal keys share one node.
2. Nodes that agree on a band share a bucket. In each bucket all nodes are
   compared with one pivot, the smallest: as many pairs as nodes.
3. Pairs are compared batch by batch of signature places and pruned once the
   posterior probability that their similarity reaches the threshold is below
   MISS. What survives is confirmed on the full shingle sets.
4. Links give components. Pairs inside a component need no comparison, so only
   buckets that hold several components are looked at again: every node outside
   the bucket's largest component against all nodes of other components. Small
   buckets list those pairs; large ones are cut into blocks that are compared
   inside a task, which gives back links only. No bucket is capped.

A pair at the threshold t shares no band with probability (1 - t^rows)^bands, 2e-6
for either setting; sets are compared by 64-bit shingle hashes.

Defined results: null, empty and blank texts have no shingles and are linked with
nothing; rows that repeat a doc_id are one document, and all get its component;
rows without a doc_id are linked with nothing, have a null component and are kept;
other columns are ignored by components() and kept by deduplicate(); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm._shared import materialise

#: Posterior probability below which a pair is given up.
MISS = 1e-7
#: Buckets with more pairs than this are compared in blocks of so many nodes a side.
PAIRS_LISTED, BLOCK = 256, 128
#: Bits of the filter that keeps rows out of a join whose ids are in no pair: so many for each id, and a bound in all.
FILTER_BITS_EACH, FILTER_BITS = 16, 1 << 26
#: Rows of ids or pairs of ids that are broadcast at most; beyond, the join shuffles.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Settings:
    """Words of a shingle; least similarity, 100 * intersection >= percent * union; rows and number of bands.

    Signatures are compared a band's number of places at a time."""

    words: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 28

    @property
    def places(self) -> int:
        return self.rows * self.bands


THREE_WORDS = Settings()
#: What holds where nothing else is said: five words, 0.8.
FIVE_WORDS = Settings(words=5, percent=80, rows=5, bands=34)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_SHIFT = np.uint64(32)


class _WordHashes(dict):
    """Hashes of words met before; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def split_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes.split takes exactly space and code points 9 to 13 as blanks."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _K[3]
    return h ^ (h >> np.uint64(29))


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than `width` are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b"\n".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        h = _mix(h + w[k : len(words) - width + 1 + k] * _K[k % 3])
    return np.unique(h)


@lru_cache(maxsize=4)
def _multipliers(places: int) -> np.ndarray:
    return np.random.default_rng(85).integers(1, 2**63, places, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(signatures as uint16, band keys as int64) of non-empty sets."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
    full = np.empty((len(sets), how.places), np.uint64)
    for k, a in enumerate(_multipliers(how.places)):
        full[:, k] = np.minimum.reduceat((flat * a) >> _SHIFT, starts)
    keys = np.tile(np.arange(1, how.bands + 1, dtype=np.uint64) * _K[1], (len(sets), 1))
    for k in range(how.rows):
        keys = _mix(keys * _K[0] + full[:, k :: how.rows])
    return (full >> np.uint64(16)).astype(np.uint16), keys.astype(np.int64)


def least_matches(places: int, percent: int, miss: float = MISS) -> int:
    """Fewest matches in so many places at which P(similarity >= t) under a uniform prior is not below `miss`."""
    t, tail = percent / 100, 0.0
    for m in range(places + 1):
        tail += comb(places + 1, m) * t**m * (1 - t) ** (places + 1 - m)
        if tail >= miss:
            return m
    return places


@lru_cache(maxsize=4)
def _steps(how: Settings) -> list[tuple[int, int]]:
    return [(k, least_matches(k + how.bands, how.percent)) for k in range(0, how.places, how.bands)]


def surviving(a: np.ndarray, b: np.ndarray, how: Settings) -> np.ndarray:
    """Indexes of the row pairs of two signature matrices that no batch prunes."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for start, least in _steps(how):
        matches += (a[left, start : start + how.bands] == b[left, start : start + how.bands]).sum(1, dtype=np.int32)
        ok = matches >= least
        left, matches = left[ok], matches[ok]
    return left


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def _matrix(column, how: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, how.places)


def sketch(docs: DataFrame, how: Settings) -> DataFrame:
    """(doc_id, n_shingles, key, sig, bands) of docs (doc_id, text); key, sig and bands are null without shingles."""

    def run(batches):
        for batch in batches:
            words = [split_words(t.as_py()) for t in batch.column("text")]
            sets = [shingle_set(w, how.words) for w in words]
            some = [k for k, s in enumerate(sets) if len(s)]
            sig, bands, keys = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if some:
                s, b = signatures([sets[k] for k in some], how)
                for row, k in enumerate(some):
                    sig[k], bands[k], keys[k] = s[row].tobytes(), b[row], xxhash.xxh3_128_digest(b" ".join(words[k]))
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, key binary, sig binary, bands array<long>")


def _sizes_allow(a: Column | str, b: Column | str, how: Settings) -> Column:
    """No smaller ratio of set sizes can reach the threshold."""
    return 100 * F.least(a, b) >= how.percent * F.greatest(a, b)


def among(ids: DataFrame) -> Callable[[Column], Column]:
    """A test whether an id may be among ids (one long column): true for all that are, and a few others.

    The ids become a bitmap of at most FILTER_BITS bits, whose 64-bit words are put together on the executors; with
    far more ids than bits the test is always true and the join that follows decides."""
    (name,) = ids.columns
    n = ids.count()
    bits = min(FILTER_BITS, 64 << max(0, (n * FILTER_BITS_EACH - 1) // 64).bit_length())
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    set_bits = ids.select(place(F.col(name)).alias("at")).select(F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))
    words = set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()

    @F.pandas_udf("boolean")
    def is_set(at: pd.Series) -> pd.Series:
        k = at.to_numpy()
        return pd.Series((bitmap[k >> 6] >> (k & 63)) & 1 != 0)

    return lambda c: c.isNotNull() & is_set(place(c.cast("long")))


def possible(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """rows whose `column` may be among ids; a join then shuffles those rows' texts and no others."""
    return rows.where(among(ids)(F.col(column)))


def _checked(ids: DataFrame) -> DataFrame:
    """Stored ids or pairs of ids, broadcast where their number allows it, so what they are joined to stays where it is."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def confirm(pairs: DataFrame, sigs: DataFrame, docs: DataFrame, how: Settings) -> DataFrame:
    """The linked ones among pairs (a, b): Bayesian pruning on sigs (node, sig), then the full sets."""

    def prune(batches):
        for batch in batches:
            left = surviving(_matrix(batch.column("sig_a").to_pylist(), how), _matrix(batch.column("sig_b").to_pylist(), how), how) if batch.num_rows else []
            yield batch.select(["a", "b"]).take(pa.array(left, pa.int64()))

    def exact(batches):
        kept: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in kept:
                if len(kept) > 64:
                    kept.clear()
                kept[text] = shingle_set(split_words(text), how.words)
            return kept[text]

        for batch in batches:
            ok = [_linked(of(x.as_py()), of(y.as_py()), how.percent) for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    ends = lambda p: p.select("a").union(p.select("b")).distinct()
    pairs = materialise(pairs, "pairs")
    near = possible(sigs, "node", ends(pairs))
    signed = _checked(pairs).join(near.toDF("a", "sig_a"), "a").join(near.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")
    left = materialise(signed.mapInArrow(prune, "a long, b long"), "candidates")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text is not null")
    texts = possible(texts, "id", ends(left))
    full = _checked(left).join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(exact, "a long, b long").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b), by alternating large and small stars until nothing changes."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        near = both if large else both.where("v < u")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("b"), F.col("m").alias("a"))
        if not large:
            out = out.union(least.select("u", "m"))
        return out.where("a <> b").select("a", "b").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = materialise(star(star(edges, True), False), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select("a", "a").distinct())


def _block_links(table: pd.DataFrame, how: Settings) -> pd.DataFrame:
    """Links between the two sides of one block pair: a forest, for links inside what is joined already add nothing."""
    o, a = table[table["side"] == 0].reset_index(drop=True), table[table["side"] == 1].reset_index(drop=True)
    so, sa = _matrix(o["sig"], how), _matrix(a["sig"], how)
    sets: dict[int, np.ndarray] = {}
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while roots.setdefault(x, x) != x:
            roots[x] = x = roots[roots[x]]
        return x

    def full(side: int, k: int, frame: pd.DataFrame) -> np.ndarray:
        key = 2 * k + side
        if key not in sets:
            sets[key] = shingle_set(split_words(frame["text"][k]), how.words)
        return sets[key]

    out = []
    for k in range(len(o)):
        n, comp = o["n"][k], o["component"][k]
        may = np.flatnonzero((a["component"].values != comp) & (100 * np.minimum(a["n"].values, n) >= how.percent * np.maximum(a["n"].values, n)))
        for j in may[surviving(np.broadcast_to(so[k], (len(may), so.shape[1])), sa[may], how)]:
            if root(comp) != root(a["component"][j]) and _linked(full(0, k, o), full(1, j, a), how.percent):
                roots[root(comp)] = root(a["component"][j])
                out.append((comp, a["component"][j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def components(docs: DataFrame, how: Settings = FIVE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of docs (doc_id, text)."""
    sketched = materialise(sketch(docs, how), "sketches")
    some = sketched.where("doc_id is not null and key is not null")
    # signatures stay in the sketches' table; a node is a key's smallest doc_id
    nodes = materialise(some.groupBy("key").agg(F.min("doc_id").alias("node")), "nodes")
    sigs = some.select(F.col("doc_id").alias("node"), "sig")
    chosen = some.join(nodes.withColumnRenamed("node", "doc_id"), ["key", "doc_id"])
    banded = chosen.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min(F.struct("node", "n")).alias("pivot"), F.count(F.lit(1)).alias("total")).where("total > 1")
    members = materialise(banded.join(shared, "band").select("band", "node", "n", "pivot", "total"), "members")
    near = members.where((F.col("node") != F.col("pivot.node")) & _sizes_allow("n", "pivot.n", how))
    links = confirm(near.select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).distinct(), sigs, docs, how)
    first = materialise(smallest_reachable(links), "first")

    labelled = members.join(first, "node", "left").select("band", "node", "n", F.coalesce("component", "node").alias("component"))
    per = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = per.groupBy("band").agg(F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = mixed.select("band", F.col("main.component").alias("main"), "total", (F.col("total") - F.col("main.size")).alias("others"))
    again = materialise(labelled.join(mixed, "band"), "again")
    few = F.col("others") * F.col("total") <= PAIRS_LISTED

    x, y = again.where(few & (F.col("component") != F.col("main"))).alias("x"), again.where(few).alias("y")
    listed = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.component") != F.col("y.component")) & _sizes_allow("x.n", "y.n", how))
    listed = listed.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    pair_links = confirm(listed, sigs, docs, how)

    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    many = again.where(~few)
    outside = many.where("component <> main").select("band", "node", "n", "component", F.lit(0).alias("side"), place("others").alias("p"), F.explode(F.sequence(F.lit(0), blocks("total") - 1)).alias("q"))
    every = many.select("band", "node", "n", "component", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), blocks("others") - 1)).alias("p"), place("total").alias("q"))
    dealt = outside.union(every)
    nodes_again = materialise(many.select("node").distinct(), "nodes-again")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where("text is not null")
    wanted = _checked(nodes_again).join(sigs, "node").join(possible(texts, "node", nodes_again), "node")
    block_links = dealt.join(materialise(wanted, "texts"), "node").groupBy("band", "p", "q").applyInPandas(lambda t: _block_links(t, how), "a long, b long")

    of = first.toDF("node", "component")
    joined = pair_links.join(of.toDF("a", "ca"), "a", "left").join(of.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = materialise(smallest_reachable(joined.union(block_links)), "second").toDF("component", "smallest")
    labels = nodes.select("key", "node").join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    labels = labels.join(second, "component", "left").select("key", F.coalesce("smallest", "component").alias("smallest"))

    rows = sketched.select("doc_id", "n_shingles", "key").join(labels, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    out = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, how: Settings = FIVE_WORDS) -> DataFrame:
    """docs with one document of each component: the smallest doc_id, and of rows that repeat it, the one of the smallest text, null last."""
    judged = materialise(components(docs, how), "judged")
    dropped = materialise(judged.where(~F.col("kept")).select(F.col("doc_id").alias("__dropped")).distinct(), "dropped")
    without = lambda rows, ids: rows.join(ids, rows["doc_id"].cast("long") == ids["__dropped"], "left_anti")
    if dropped.count() <= BROADCAST_ROWS:
        left = without(docs, F.broadcast(dropped))
    else:
        # only texts that may go are shuffled, not the whole corpus
        may_go = among(dropped)(docs["doc_id"])
        left = docs.where(~may_go).union(without(docs.where(may_go), dropped))
    again = judged.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    again = materialise(again.select(F.col("doc_id").alias("__again")), "again-ids")
    if again.isEmpty():
        return left
    # combined before the shuffle, so an id that many rows repeat meets as one row a partition
    may_repeat = among(again)(left["doc_id"])
    order = F.struct(left["text"].isNull(), left["text"], F.hash(*(left[f.name] for f in left.schema if "map<" not in f.dataType.simpleString())))
    one = left.where(may_repeat).groupBy("doc_id").agg(F.min_by(F.struct(*(left[c] for c in left.columns)), order).alias("__row"))
    return left.where(~may_repeat).union(one.select("__row.*"))
