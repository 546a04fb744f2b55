import random
import re

import numpy as np
import pytest

from callweave.llm import neardup
from callweave.llm._shared import prepare


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    """doc_id -> smallest reachable doc_id, all pairs compared; rows of one doc_id are one document."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    label = {d: d for d, _ in sets}
    changed = True
    edges = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return label


def corpus(seed, groups, size, words=120):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(5000)]
    rows = []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4, 6, 10])):
                text[r.randrange(words)] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(text) if r.random() < 0.9 else " ".join(base)))
    return rows


@pytest.mark.parametrize("listed,block", [(256, 512), (4, 16)])
def test_components_match_brute_force(spark, monkeypatch, listed, block):
    monkeypatch.setattr(neardup, "PAIRS_LISTED", listed)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = corpus(3, 12, 4) + [(d + 10_000, t) for d, t in corpus(4, 2, 60)]
    want = brute(rows)
    got = {r["doc_id"]: r for r in neardup.components(prepare(spark).createDataFrame(rows, "doc_id long, text string"), neardup.THREE_WORDS).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["kept"] == (d == want[d]) for d, r in got.items())
    assert all(got[d]["n_shingles"] == len(shingles(t)) for d, t in rows)


def test_edge_rows(spark):
    long = " ".join(f"x{k % 977}y{k % 31}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one"), (7, long), (8, long + " z"), (9, "a b c d"), (9, "p q r s t"), (10, "P q R s t"), (None, "a b c d"), (3, " "), (11, "a\xa0b é"), (11, "a\xa0b é")]
    docs = prepare(spark).createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n long, component_id string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.components(docs, neardup.THREE_WORDS).collect()]
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got}
    assert [by[k][1] for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)] == [1, 2, 3, 4, 4, 6, 7, 7, 9, 9, 11]
    assert by[None] == (2, None, True) and by[1] == (0, 1, True) and by[5] == (1, 4, False)
    kept = neardup.deduplicate(docs, neardup.THREE_WORDS)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 7, 9, None, 11]))
    assert neardup.components(docs.limit(0)).count() == 0


def test_pruning_bounds_keep_pairs_at_the_threshold():
    """At the threshold fewer than 1 pair in 10^4 is pruned; far below it nearly all are."""
    r = np.random.default_rng(1)
    a = r.integers(0, 2**16, (20_000, neardup.THREE_WORDS.places)).astype(np.uint16)
    for similarity, least, most in ((0.85, 0.9999, 1), (0.5, 0, 0.01)):
        b = np.where(r.random(a.shape) < similarity, a, a + 1).astype(np.uint16)
        assert least <= len(neardup.surviving(a, b, neardup.THREE_WORDS)) / len(a) <= most


@pytest.mark.parametrize("rows", [500_000, 0])
def test_deduplicate_by_broadcast_and_by_shuffle(spark, monkeypatch, rows):
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", rows)
    corpus_rows = [*corpus(5, 6, 4), (None, "a b c d"), (None, None), (900, None), (0, "again here")]
    kept = neardup.deduplicate(prepare(spark).createDataFrame([(*r, "k") for r in corpus_rows], "doc_id long, text string, kept string"), neardup.THREE_WORDS)
    want = brute([r for r in corpus_rows if r != (0, "again here")])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([*(str(d) for d, c in want.items() if d == c), "None", "None"])


def test_of_rows_that_repeat_an_id_the_smallest_text_stays(spark):
    rows = [(1, "b one two three", "x"), (1, "a four five six", "y"), (1, None, "z"), (2, None, "x"), (2, "c seven eight", "y"), (3, "alone here now", "x"), (None, "n", "x"), (None, "n", "x")]
    for columns in ("doc_id long, text string, kept string", "doc_id int, text string, `__again` string"):
        docs = prepare(spark).createDataFrame([*rows, *[(4, "many many", "x")] * 50], columns).repartition(4)
        kept = neardup.deduplicate(docs)
        assert kept.schema.names == docs.schema.names
        assert sorted((str(r[0]), r[1]) for r in kept.collect()) == sorted([("1", "a four five six"), ("2", "c seven eight"), ("3", "alone here now"), ("4", "many many"), ("None", "n"), ("None", "n")])
