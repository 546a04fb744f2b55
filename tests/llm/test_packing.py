import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm import packing, tokens


def placed(histogram, capacity):
    """sequence -> [(offset, length)] of a plan; every rank of every length is placed once."""
    bins, ranks = {}, {k: [] for k in histogram}
    for length, rank, n, first, offset in packing.packing_plan(histogram, capacity):
        for i in range(n):
            bins.setdefault(first + i, []).append((offset, length))
            ranks[length].append(rank + i)
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in histogram.items())
    return bins


def gapless(bins, capacity):
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity


def first_fit_decreasing(histogram, capacity):
    open_, n = [], 0
    for length in sorted((k for k, c in histogram.items() for _ in range(c)), reverse=True):
        fit = next((k for k, gap in enumerate(open_) if gap >= length), None)
        if fit is None:
            open_.append(capacity - length)
        else:
            open_[fit] -= length
    return len(open_)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 48), st.integers(1, 9), max_size=30))
def test_plans_are_whole_and_as_good_as_a_plain_packer(histogram):
    bins = placed(histogram, 48)
    gapless(bins, 48)
    for items in bins.values():
        assert sum(3 * length > 48 for _, length in items) <= 2
    assert len(bins) <= 1.1 * first_fit_decreasing(histogram, 48) + 1


def test_plan_size_depends_on_the_capacity_only():
    sizes = [len(packing.packing_plan({k: times * (k % 7 + 1) for k in range(1, 2049)})) for times in (1, 10**3, 10**7)]
    assert max(sizes) < 20_000
    total, bins = sum(k * 10**7 * (k % 7 + 1) for k in range(1, 2049)), max(f + n for _, _, n, f, _ in packing.packing_plan({k: 10**7 * (k % 7 + 1) for k in range(1, 2049)}))
    assert bins <= 1.02 * total / 2048


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 5000, 6144])
def test_cuts(n):
    parts = packing.cut(n, 2048)
    assert sum(length for _, length in parts) == n and all(length == 2048 for _, length in parts[1:])
    assert [s for s, _ in parts] == list(np.cumsum([0, *(length for _, length in parts)])[: len(parts)])


def test_ids_are_the_tokenizer_files():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(3)
    texts = ["", " ", "a", "Don't  stop\n\n\tnow", "<|endoftext|> inside <|endoftext|>", "naïve café — 日本語 \U0001f600 12345", "  x \r\n"]
    texts += ["".join(r.choice(" ab'sé\n1,<|>") for _ in range(r.randint(1, 200))) for _ in range(200)]
    for text in texts:
        assert tokens.token_ids(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_tables_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 5)
    r = random.Random(1)
    rows = [(1, None), (2, ""), (2, ""), (None, "x y z"), (3, "word " * 9000), (4, "<|endoftext|>")]
    rows += [(k, " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(r.randint(1, 400)))) for k in range(10, 200)]
    rows += [(1000 + k, "copy of one text") for k in range(100)]
    got = [r.asDict() for r in packing.pack(spark.createDataFrame([(*x, 7, "k") for x in rows], "doc_id long, text string, offset long, piece string")).collect()]
    want = []
    for doc_id, text in rows:
        ids = [*tokens.token_ids(text).tolist(), 0]
        want += [(str(doc_id), k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048))]
    assert sorted((str(g["doc_id"]), g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == sorted(want)
    bins = {}
    for g in got:
        bins.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    gapless(bins, 2048)
    assert len(bins) <= -(-sum(g["length"] for g in got) // 2048) + 2
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
