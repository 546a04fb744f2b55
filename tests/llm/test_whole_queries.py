"""Queries without SQL against plain forms of their rules, over all rows of the smallest tables."""

import base64
import gzip
import hashlib
import random
import urllib.parse
import zlib

import numpy as np
import pytest
import zstandard

from callweave.llm import langid, registry, secrets, toxicity
from callweave.llm._shared import prepare

from test_secrets import brute

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    rows = prepare(spark).read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r["doc_id"]: r for r in rows}


def answers(spark, query):
    return {r["doc_id"]: r.asDict() for r in query(spark, DATA).collect()}


def test_media_query(spark, documents):
    got = answers(spark, registry.op1_lossless_webp)
    assert got.keys() == documents.keys()
    for k, r in documents.items():
        data = (r["text"] or "").encode()
        payload = data + b"\0" * (-len(data) % 64 or (64 if not data else 0))
        g = got[k]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def plain_score(word, table, pairs):
    """Log probability of a word's letters, each after the two before it, by the model's hashed counts."""

    def bucket(*codes):
        h = 0
        for c in codes:
            h = (h ^ c) * 0x9E3779B97F4A7C15 % 2**64
            h ^= h >> 29
        return h % langid.BUCKETS

    letters = [ord(c) if c.isalpha() else 0 for c in word] + [0]
    total, before = 0.0, (0, 0)
    for c in letters:
        if c or before[1]:
            total += float(table[bucket(*before, c)]) - float(pairs[bucket(*before)])
        before = (before[1] if c else 0, c) if c else (0, 0)
        if before[1] and not before[0]:
            before = (0, c)
    return total


def plain_labels(text, model):
    """(language, score, spans) by scoring every word in every language and a full Viterbi recursion."""
    words = (text or "").lower().split()
    rows, letters = [], []
    for w in words:
        n = sum(c.isalpha() for c in w)
        rows.append([plain_score(w, t, p) if n else 0.0 for t, p in zip(model.trigrams, model.pairs, strict=True)])
        letters.append(n)
    if not sum(letters):
        return "und", 0.0, ""
    best, back = rows[0], []
    for row in rows[1:]:
        came = [max(range(len(best)), key=lambda s, to=to: best[s] - langid.SWITCH * (s != to)) for to in range(len(best))]
        back.append(came)
        best = [best[s] - langid.SWITCH * (s != to) + row[to] for to, s in enumerate(came)]
    path = [max(range(len(best)), key=best.__getitem__)]
    for came in reversed(back):
        path.append(came[path[-1]])
    path.reverse()
    held = [sum(n for n, p in zip(letters, path, strict=True) if p == s) for s in range(len(best))]
    top = max(range(len(best)), key=held.__getitem__)
    cuts = [0, *(k for k in range(1, len(path)) if path[k] != path[k - 1]), len(path)]
    return model.languages[top], held[top] / sum(letters), ",".join(f"{model.languages[path[a]]}:{a}:{b}" for a, b in zip(cuts, cuts[1:], strict=False))


def test_language_query(spark, documents):
    got = answers(spark, registry.op4_language_spans)
    model = langid.train(langid.learnable(spark.read.parquet(f"{DATA}/documents.parquet")))
    assert got.keys() == documents.keys()
    same = 0
    for k, r in documents.items():
        lang, score, spans = plain_labels(r["text"], model)
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert (got[k]["lang_pred"], round(got[k]["score"], 9)) == (lang, round(score, 9)), k
        same += got[k]["spans"] == spans
    assert same == len(documents)


def test_secret_query(spark, documents):
    got = answers(spark, registry.op6_secret_scan)
    assert got.keys() == documents.keys()
    for k, r in documents.items():
        want = brute(r["text"] or "")
        listed = [f"{kind}:{a}:{b}" for kind, a, b in want]
        g = got[k]
        assert (g["n_assign"], g["n_access"], g["n_hex"]) == tuple(sum(s[0] == kind for s in want) for kind in secrets.KINDS)
        assert g["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(g["spans"].split(",")) | {""} and g["unopened"] == 0


WRAPS = {
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode(),
    "percent": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "quoted": lambda s: urllib.parse.quote(s, safe=""),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "braced": lambda s: "".join(f"\\u{{{ord(c):x}}}" for c in s),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
}


def test_every_nest_of_encodings_is_opened_and_mapped():
    """A secret in any chain of encodings, growth of escapes kept small, is found within the run that holds it."""
    r = random.Random(11)
    for _ in range(250):
        secret, run, chain = f"password={r.getrandbits(48):012x}zz", None, []
        run = f"note {secret} end"
        for _ in range(r.randint(1, 6)):
            name = r.choice(list(WRAPS))
            if len(run) > 4000 and name in ("percent", "unicode", "braced"):
                continue
            chain.append(name)
            run = WRAPS[name](run)
        if not chain:
            continue
        text = f"é before {run} after"
        _, spans, unopened = secrets.scan_text(text)
        a, b = 9, 9 + len(run)
        assert any(kind == "assign" and a <= s < e <= b for kind, s, e in spans), chain
        assert unopened == 0 and all(e <= a or s >= b or a <= s and e <= b for _, s, e in spans), chain
        assert not any(kind == "assign" for kind, *_ in secrets.scan_text(secrets.mask(text, spans))[1]), chain


def test_toxicity_query(spark, documents):
    got = answers(spark, registry.op7_toxicity)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{DATA}/documents.parquet"), labels)
    assert got.keys() == documents.keys() and model is not None
    settings = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **toxicity.SEARCH)
    size = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings) for d in (model.ordinary, model.toxic)]
    for k, r in documents.items():
        words = (r["text"] or "").lower().encode().split()
        gains, at = [], 0
        while words and (at == 0 or at + toxicity.WINDOW - toxicity.STEP < len(words)):
            window = b" " + b" ".join(words[at : at + toxicity.WINDOW]) + b"  " + model.ordinary[-toxicity.FRAME :]
            gains.append(len(size[0].compress(window)) - len(size[1].compress(window)))
            at += toxicity.STEP
        evidence = sum(max(0, g - toxicity.FLOOR) for g in gains) / np.sqrt(len(gains) + toxicity.SPARE)
        g = got[k]
        assert (g["held_out"], g["windows"]) == (zlib.crc32(str(k).encode()) % 5 == 0, len(gains))
        assert abs(g["evidence"] - evidence) < 1e-9 and g["predicted"] == int(evidence >= model.threshold) == int(g["score"] >= 0.5)
