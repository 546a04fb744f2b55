"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on windows of toxic text, one on windows of ordinary text;
a common part, trained on ordinary windows, ends both, so ordinary language costs the
same under both. A window of WINDOW words is compressed with each; its gain is how
many bytes the toxic dictionary saves.

Most windows of a toxic text are ordinary language, so training goes in rounds. The
first takes the windows that the common part shortens least. Every later one takes
the toxic texts' windows that gain more than all but ORDINARY_ABOVE of the ordinary
windows do, each trimmed to its shortest run of words that keeps a KEEP part of the
gain, and the ordinary windows that gain least. Gains are always measured by
dictionaries that were trained without the window's own text (FOLDS parts, texts that
share a passage with an earlier one left out), so what is taken is what toxic texts
have in common and not what one of them says.

A text's evidence is the sum of its windows' gains above FLOOR, divided by the root of
their number, because long texts have more windows that gain by chance. The threshold
is calibrated for the best F1 on the sampled texts, each measured by dictionaries
trained without it; scores are a logistic curve around the threshold.

Defined results: null and empty texts have no windows and evidence 0; rows without
doc_id are never learned from and not held out; conflicting repeated labels each
count; without labels of both classes every score is 0; repeated rows score alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.langid import fold

#: Expected labelled rows of each class in the sample that is learned from.
SAMPLE_PER_CLASS = 2000
#: Words of a sampled text that are learned from: of longer texts, evenly spaced runs; longer words are left out.
SAMPLE_WORDS, SAMPLE_RUNS, SAMPLE_WORD_BYTES = 4096, 16, 256
#: Words of a window, and from one window's start to the next.
WINDOW, STEP = 8, 4
#: Bytes of the dictionaries' common part and of each one's own.
COMMON_BYTES, OWN_BYTES = 262_144, 2_048
ROUNDS, FOLDS = 5, 3
ORDINARY_ABOVE, KEEP = 0.001, 0.5
#: Bytes of the sequences that the trainer counts, and of the segments that it takes for each part.
SEQUENCE, COMMON_SEGMENT, OWN_SEGMENT = 6, 40, 20
#: Bytes of the common part that stand beside each window, which keeps short windows compressible.
FRAME = 24
#: Lazy matching: a greedy parse adds noise of several bytes.
SEARCH = dict(strategy=zstandard.STRATEGY_LAZY, window_log=19, hash_log=17, chain_log=17, search_log=4, min_match=4)
#: Gain of a window that counts as chance, and windows added to a text's number so that short texts need as much.
FLOOR, SPARE = 2, 20
#: Steepness of the score's logistic curve, per threshold.
STEEP = 4.0
#: Windows that are compressed in one call.
BLOCK = 20_000


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    threshold: float


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def windows(words: list[bytes]) -> list[list[bytes]]:
    return [words[k : k + WINDOW] for k in range(0, max(1, len(words) - WINDOW + STEP), STEP)] if words else []


class Lengths:
    """Compressed lengths under one dictionary, whose bytes are used as content: entropy tables would differ by class."""

    def __init__(self, dictionary: bytes) -> None:
        plain = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **SEARCH)
        content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._all = zstandard.ZstdCompressor(dict_data=content, compression_params=plain).multi_compress_to_buffer

    def __call__(self, items: list[bytes]) -> np.ndarray:
        out = []
        for k in range(0, len(items), BLOCK):
            some = items[k : k + BLOCK]
            sizes = np.fromiter(map(len, some), np.uint64, len(some))
            places = np.stack([np.cumsum(sizes) - sizes, sizes], 1).astype(np.uint64)
            packed = self._all(zstandard.BufferWithSegments(b"".join(some), places.tobytes()), threads=0)
            out.append(np.fromiter(map(len, packed), np.int64, len(some)))
        return np.concatenate(out) if out else np.zeros(0, np.int64)


class Gains:
    """Bytes that the toxic dictionary saves on windows of words."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self._ordinary, self._toxic, self._frame = Lengths(ordinary), Lengths(toxic), ordinary[-FRAME:]

    def of(self, runs: list[list[bytes]]) -> np.ndarray:
        framed = [b" ".join((b"", *run, b"", self._frame)) for run in runs]
        return self._ordinary(framed) - self._toxic(framed)


def evidence(gains: np.ndarray) -> float:
    return float(np.maximum(0, gains - FLOOR).sum() / np.sqrt(len(gains) + SPARE))


def _dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary; the samples' own end where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, [b" " + s + b" " for s in samples], d=SEQUENCE, k=segment).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(sorted(set(samples)))[-size:]


def _pair(ordinary: list[bytes], toxic: list[bytes], common: bytes, size: int) -> tuple[bytes, bytes]:
    """Both dictionaries, of one length, so that the common part is as far from a window in either."""
    own = [_dictionary(x, size, OWN_SEGMENT) for x in (ordinary, toxic)]
    n = min(map(len, own))
    a, b = (x[len(x) - n :] + common for x in own)
    return a, b


def _fresh(texts: list[list[bytes]]) -> list[list[bytes]]:
    """Texts that share no window's worth of words with an earlier one: copies would vouch for each other."""
    seen: set = set()
    out = []
    for words in texts:
        own = {hash(tuple(words[k : k + WINDOW])) for k in range(max(1, len(words) - WINDOW + 1))}
        if words and own.isdisjoint(seen):
            out.append(words)
        seen |= own
    return out


def _trimmed(runs: list[list[bytes]], gains: np.ndarray, part: np.ndarray, measure: list[Gains]) -> list[bytes]:
    """Of each run the shortest stretch of its words that keeps a KEEP part of its gain."""
    tried = [(k, run[a:b]) for k, run in enumerate(runs) for a in range(len(run)) for b in range(a + 1, len(run) + 1)]
    of = np.fromiter((k for k, _ in tried), np.int64, len(tried))
    found = np.zeros(len(tried), np.int64)
    for f, m in enumerate(measure):
        here = np.flatnonzero(part[of] == f)
        found[here] = m.of([tried[k][1] for k in here])
    out = [b" ".join(run) for run in runs]
    for (k, words), gain in zip(tried, found.tolist(), strict=True):
        if gain >= max(1, KEEP * gains[k]) and len(short := b" ".join(words)) < len(out[k]):
            out[k] = short
    return out


def fit(rows: list[tuple[str | None, int]]) -> Model | None:
    """A model from (text, label) rows; None unless both labels occur."""
    texts = [_fresh([words_of(t) for t, y in rows if y == label]) for label in (0, 1)]
    if not all(texts):
        return None
    runs = [[w for words in of for w in windows(words)] for of in texts]
    part = [np.array([k % FOLDS for k, words in enumerate(of) for _ in windows(words)]) for of in texts]
    plain = [[b" ".join(w) for w in of] for of in runs]
    common = _dictionary(plain[0], COMMON_BYTES, COMMON_SEGMENT)
    shortened = Lengths(common)
    cost = [shortened([b" ".join((b"", w, b"", common[-FRAME:])) for w in of]) / np.fromiter(map(len, of), np.int64, len(of)) for of in plain]
    dear = np.quantile(cost[0], 0.95)
    places = [np.flatnonzero(c > dear) for c in cost]
    taken = [[of[k] for k in at] for of, at in zip(plain, places, strict=True)]
    gains = [np.zeros(len(of), np.int64) for of in plain]
    for turn in range(ROUNDS):
        measure = []
        for f in range(FOLDS):
            others = [[w for w, k in zip(t, at, strict=True) if p[k] != f] for t, at, p in zip(taken, places, part, strict=True)]
            measure.append(Gains(*_pair(*others, common, OWN_BYTES * (4 if turn == 0 else 1))))
            for y in (0, 1):
                here = np.flatnonzero(part[y] == f)
                gains[y][here] = measure[f].of([runs[y][k] for k in here])
        if turn == ROUNDS - 1:
            break
        least = max(FLOOR, float(np.quantile(gains[0], 1 - ORDINARY_ABOVE)))
        rising = np.flatnonzero(gains[1] > least)
        if not len(rising):
            break
        falling = np.argsort(gains[0], kind="stable")[: max(FOLDS * 500, len(rising))]
        places = [falling, rising]
        taken = [[plain[0][k] for k in falling], _trimmed([runs[1][k] for k in rising], gains[1][rising], part[1][rising], measure)]
    ordinary, toxic = _pair(*taken, common, OWN_BYTES)
    found = [(evidence(gains[y][a:b]), y) for y in (0, 1) for a, b in _spans([len(windows(words)) for words in texts[y]])]
    return Model(ordinary, toxic, _threshold(found))


def _spans(sizes: list[int]) -> list[tuple[int, int]]:
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _threshold(found: list[tuple[float, int]]) -> float:
    """The middle of the gap at which picking all above it has the best F1."""
    found = sorted(found, reverse=True)
    best, at, right, total = 0.0, None, 0, sum(y for _, y in found)
    for k, (value, y) in enumerate(found):
        right += y
        below = found[k + 1][0] if k + 1 < len(found) else 0.0
        f1 = 2 * right / (k + 1 + total)
        if value > below and f1 > best and 2 * right > k:
            best, at = f1, (value + below) / 2
    return at if at else 1 + (found[0][0] if found else 0.0)


def _sample(words: list[bytes]) -> list[bytes]:
    """At most SAMPLE_WORDS words of a text: all of them, or evenly spaced runs."""
    words = [w for w in words if len(w) <= SAMPLE_WORD_BYTES]
    size = SAMPLE_WORDS // SAMPLE_RUNS
    if len(words) <= SAMPLE_WORDS:
        return words
    starts = np.linspace(0, len(words) - size, SAMPLE_RUNS).astype(int)
    return [w for s in starts for w in words[s : s + size]]


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """A model from about per_class labelled rows of each class, chosen by hash, outside the held-out fold."""
    known = labels.where("toxic in (0, 1)").where(fold("doc_id", 5) != 0).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    # a draw out of 2^40 keeps the sample's expected size at any number of rows
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    chosen = known.where(draw < share * float(1 << 40)).distinct().collect()
    of = defaultdict(list)
    for r in chosen:
        of[r["doc_id"]].append(r["toxic"])

    def shorten(batches):
        for batch in batches:
            texts = [b" ".join(_sample(words_of(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "words"])

    # the ids are as few as the sample: a filter on them reads the table once and shuffles nothing
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where(F.col("doc_id").isin(list(of))).select("doc_id", "text").mapInArrow(shorten, f"doc_id {kind}, words binary").collect()
    rows = {(bytes(r["words"]).decode("utf-8", "surrogatepass"), y) for r in texts for y in of[r["doc_id"]]}
    return fit(sorted(rows))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, windows) of docs (doc_id, text)."""

    def run(batches):
        gains = Gains(model.ordinary, model.toxic) if model else None
        for batch in batches:
            found, sizes = [], []
            for text in batch.column("text"):
                runs = windows(words_of(text.as_py()))
                sizes.append(len(runs))
                found.append(evidence(gains.of(runs)) if gains else 0.0)
            score = [1 / (1 + exp(min(50.0, STEEP * (1 - e / model.threshold)))) if model else 0.0 for e in found]
            columns = [pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()), pa.array(found, pa.float64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], ["doc_id", "held_out", "score", "predicted", "evidence", "windows"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence double, windows long")
