"""Language identification of mixed texts: scripts, per-word scores, Viterbi spans.

A word's letters give its script; languages that were learned without that script
are out. The rest are scored by a letter-trigram model, learned from a bounded
sample of labelled rows. Over the words of a text Viterbi finds the best labelling
when each change of language costs SWITCH nats, so a text splits into spans of one
language each. The text's language is the one whose spans hold most letters.

Where no other language gains more than half of SWITCH on any stretch, the best
single language is the Viterbi optimum, and the recursion is skipped.

Defined results: null texts and texts without letters are `und` with score 0 and
no spans; words without letters score alike in all languages; ties go to the
language that sorts first; rows without doc_id are never learned from and not
held out; if nothing can be learned every text is `und`; an empty table gives an
empty result; other columns are ignored by predict() and kept by keep_known().
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Expected labelled documents of each language that the model is fitted on.
SAMPLE_PER_LANGUAGE = 1000
#: Nats that a change of language costs.
SWITCH = 12.0
#: Nats by which a language without the word's script, which is not scored, stands below the best candidate.
WRONG_SCRIPT = 40.0
#: Share of a language's letters from which a script counts as its own.
SCRIPT_SHARE = 0.01
BUCKETS = 1 << 16
SMOOTHING = 2.0
#: Least share of letters that a document's language must hold in keep_known().
LEAST_SHARE = 0.3

#: First and last code point of the main blocks of each script.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
NAMES = tuple(dict.fromkeys(x[0] for x in SCRIPTS))
#: Scripts that are written without blanks: up to four characters count as a word, so spans may begin and end inside a line.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]{1,4})"


@lru_cache(maxsize=1)
def _script_table() -> np.ndarray:
    """For every code point: 0 if it is no letter, 1 for a letter of no listed script, else 2 + the script's place."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    for name, first, last in SCRIPTS:
        block = table[first : last + 1]
        block[block > 0] = 2 + NAMES.index(name)
    return table


@dataclass
class Model:
    """languages; log counts of letter trigrams and of their first two letters; allowed[script, language]."""

    languages: list[str]
    trigrams: np.ndarray
    pairs: np.ndarray
    allowed: np.ndarray


@dataclass
class Words:
    """Distinct words as code points: the letters' classes, trigram buckets and where each word starts."""

    classes: np.ndarray
    trigrams: np.ndarray
    pairs: np.ndarray
    starts: np.ndarray


def _hashed(*codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(word numbers of all texts in a row, offsets of each text, distinct lower-case words)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if pc.any(pc.match_substring_regex(texts, UNSPACED)).as_py():
        texts = pc.replace_substring_regex(texts, UNSPACED, r" \1 ")
    words = pc.utf8_split_whitespace(pc.utf8_lower(pc.utf8_trim_whitespace(texts)))
    coded = words.flatten().dictionary_encode()
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    return coded.indices.to_numpy(), offsets, coded.dictionary.to_pylist()


def _words(distinct: list[str]) -> Words:
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1
    codes = np.frombuffer("".join(w + " " for w in distinct).encode("utf-32-le"), np.uint32).astype(np.int64)
    classes = _script_table()[codes]
    plain = np.where(classes > 0, codes, 0).astype(np.uint64)
    one, two = np.roll(plain, 1), np.roll(plain, 2)
    if len(plain):
        one[0] = 0
    # a word's score is its own: nothing before its blank counts
    two = np.where(one > 0, two, 0)
    return Words(classes, _hashed(two, one, plain), _hashed(two, one), np.cumsum(lengths) - lengths)


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of doc_id as text modulo the number of folds; null without doc_id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def train(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from rows (doc_id, text, lang); at most about per_language rows of each language, chosen by hash, are read.

    Trigram counts are summed on the executors; what reaches the driver is bounded by languages * 2 * BUCKETS numbers."""
    rows = rows.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    shape = (len(languages), BUCKETS)
    tri, pair, scripts = np.zeros(shape), np.zeros(shape), np.zeros((len(NAMES) + 2, len(languages)))
    if not languages:
        return Model([], tri, pair, scripts > 0)

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            for lang in set(langs.tolist()):
                numbers, _, distinct = _split(batch.column("text").filter(pa.array(langs == lang)))
                w, times = _words(distinct), np.bincount(numbers, minlength=len(distinct))
                times = np.repeat(times, np.diff([*w.starts, len(w.classes)]))
                out = [(kind, np.bincount(x, weights=times)) for kind, x in ((0, w.trigrams), (1, w.pairs), (2, w.classes))]
                for kind, n in out:
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(n[at])], ["lang", "kind", "at", "n"])

    draws = 1 << 40
    share = F.element_at(F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, per_language / n) * draws)))), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(draws)) < share).select("text", "lang")
    place = {x: k for k, x in enumerate(languages)}
    for r in chosen.mapInArrow(count, "lang string, kind int, at long, n double").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toLocalIterator():
        if r["kind"] == 2:
            scripts[r["at"], place[r["lang"]]] = r["n"]
        else:
            (tri, pair)[r["kind"]][place[r["lang"]], r["at"]] = r["n"]
    scripts[0] = 0
    allowed = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    return Model(languages, np.log(tri + SMOOTHING / 100).astype(np.float32), np.log(pair + SMOOTHING).astype(np.float32), allowed)


def word_scores(w: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(score of each distinct word in each language, number of its letters)."""
    letters = w.classes > 0
    count = np.add.reduceat(letters.astype(np.int64), w.starts)
    inner = letters | np.roll(letters, 1)
    sizes = np.diff([*w.starts, len(w.classes)])
    candidates = model.allowed[np.maximum.reduceat(w.classes, w.starts)]
    scores = np.full(candidates.shape, -np.inf)
    for k, (t, p) in enumerate(zip(model.trigrams, model.pairs, strict=True)):
        mine = candidates[:, k]
        if mine.any():
            # only words in this language's scripts are scored
            at = np.repeat(mine, sizes)
            starts = np.cumsum(sizes[mine]) - sizes[mine]
            scores[mine, k] = np.add.reduceat(np.where(inner[at], t[w.trigrams[at]] - p[w.pairs[at]], 0), starts)
    best = scores.max(1, initial=-np.inf)
    scores = np.where(candidates, scores, (best - WRONG_SCRIPT)[:, None])
    scores[(count == 0) | ~candidates.any(1)] = 0
    return scores, count


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The state of each row that maximises the sum of scores less `switch` for each change."""
    rows, best, back = scores.tolist(), None, []
    for row in rows:
        if best is None:
            best = row
            continue
        top = max(range(len(best)), key=best.__getitem__)
        enter = best[top] - switch
        back.append([s if x >= enter else top for s, x in enumerate(best)])
        best = [y + (x if x >= enter else enter) for x, y in zip(best, row, strict=True)]
    path = [max(range(len(best)), key=best.__getitem__)]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def _gains(scores: np.ndarray, best: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text the most that another language gains over the best one on any stretch of words."""
    n = len(sizes)
    shift = np.repeat(np.arange(n) * (1.0 + 4 * np.abs(scores).max() * sizes.max()), sizes)
    own = scores[np.arange(len(scores)), np.repeat(best, sizes)]
    most = np.zeros(n)
    for k in range(scores.shape[1]):
        run = np.cumsum(scores[:, k] - own)
        run = run - np.repeat(run[starts] - (scores[:, k] - own)[starts], sizes) - shift
        low = np.minimum(np.minimum.accumulate(run), -shift)
        most = np.maximum(most, np.maximum.reduceat(run - low, starts))
    return most


def label(texts: pa.Array, model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """(language, its share of the letters, spans (language, first word, end word)) of each text."""
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    numbers, offsets, distinct = _split(texts)
    rows = np.flatnonzero(np.diff(offsets))
    if not len(rows) or not model.languages:
        return out
    by_word, by_letters = word_scores(_words(distinct), model)
    scores, letters, starts, sizes = by_word[numbers], by_letters[numbers], offsets[rows], np.diff(offsets)[rows]
    best = np.add.reduceat(scores, starts).argmax(1)
    total, gains = np.add.reduceat(letters, starts), _gains(scores, best, starts, sizes)
    for row, s, n, top, all_letters, gain in zip(rows, starts, sizes, best, total, gains, strict=True):
        if not all_letters:
            continue
        if gain <= switch / 2:
            out[row] = (model.languages[top], 1.0, [(model.languages[top], 0, int(n))])
            continue
        path = viterbi(scores[s : s + n], switch)
        held = np.bincount(path, weights=letters[s : s + n], minlength=len(model.languages))
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), int(n)]
        spans = [(model.languages[path[a]], a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        top = int(held.argmax())
        out[row] = (model.languages[top], float(held[top] / all_letters), spans)
    return out


def written_share(texts: pa.Array, model: Model) -> list[float]:
    """Share of each text's letters that stand in a script of a learned language; 1 without letters or languages."""
    used = model.allowed.any(1) if model.languages else np.ones(len(NAMES) + 2, bool)
    out = []
    for text in texts:
        classes = _script_table()[np.frombuffer((text.as_py() or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
        times = np.bincount(classes, minlength=len(used))
        out.append(float(times[1:][used[1:]].sum() / times[1:].sum()) if times[1:].any() else 1.0)
    return out


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of docs (doc_id, text); the fold that is not learned from is held out."""

    def run(batches):
        for batch in batches:
            found = label(batch.column("text"), model, switch)
            spans = [",".join(f"{k}:{a}:{b}" for k, a, b in s) for _, _, s in found]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], ["doc_id", "held_out", "lang_pred", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    return chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, spans string")


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang")


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """predict() of docs by a model learned from docs' own labelled rows."""
    return predict(docs, train(learnable(docs), per_language))


def keep_known(docs: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """docs without the rows whose text has no letter, no language that holds `least` of its letters, or less than
    `least` of them in the scripts that learned languages are written in."""
    model = train(learnable(docs))

    @F.pandas_udf("boolean")
    def known(texts):
        import pandas as pd

        texts = pa.array(texts, pa.string(), from_pandas=True)
        written = written_share(texts, model)
        return pd.Series([x[0] != UNKNOWN and x[1] >= least and s >= least for x, s in zip(label(texts, model), written, strict=True)])

    return docs.where(known(docs["text"]))
