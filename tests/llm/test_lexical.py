import math
import re

import pytest

from callweave.llm import lexical
from callweave.llm._shared import prepare

KEEPS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(KEEPS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, most=10):
    """Every item against every document, by the rule as told."""
    split = [(d, terms(t)) for d, t in docs]
    some, total = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    holding = {}
    for _, w in split:
        for t in set(w):
            holding[t] = holding.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(terms(t))
    out = []
    for i, query in wanted.items():
        scores = []
        for d, w in split:
            if w:
                m = 100 - 75 + 75 * len(w) * some // total
                weight = lambda t: math.floor(1000 * math.log((2 * some + 2) / (2 * holding[t] + 1)))
                scores.append((-sum(weight(t) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in query if t in w), d is None, d or 0))
        out += [(i, k + 1, None if lacks else d, -s) for k, (s, lacks, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:most])]
    return sorted(out, key=repr)


DOCS = [(1, "The cat sat."), (2, None), (3, ""), (4, "the CAT the cat"), (5, "the cat the cat"), (5, "a dog"), (None, "the cat the cat"), (6, "été n°5 -- 42 x_y"), (7, ". , ;"), (8, "cat " * 40_000 + "été"), (9, "Cat"), (10, "İ ÉTÉ été")]
ITEMS = [(1, "cat the the"), (2, None), (3, "été 5 42 X"), (4, "unknown words"), (1, "dog"), (None, "cat"), (5, "é" * 3000 + " the"), (6, "cat"), (6, "cat")]


@pytest.mark.parametrize("entries,docs_in_block,parts", [(200_000, 8_192, 64), (3, 2, 2)])
def test_edge_rows_match_brute_force(spark, monkeypatch, entries, docs_in_block, parts):
    for name, value in (("ENTRIES", entries), ("BLOCK_DOCS", docs_in_block), ("PARTS", parts)):
        monkeypatch.setattr(lexical, name, value)
    docs = prepare(spark).createDataFrame([(*r, 7, "s") for r in DOCS], "doc_id long, text string, score long, item_id string").repartition(3)
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, rank int")
    found = lexical.search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(DOCS, ITEMS)


def test_ties_are_cut_at_the_smallest_ids(spark):
    rows = [(k, "same words here") for k in range(100, 0, -1)] + [(0, "other")]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([("a", "words")], "item_id string, text string")
    assert [r["doc_id"] for r in lexical.search(docs, items, 7).orderBy("rank").collect()] == list(range(1, 8))


def test_empty_tables(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    for d, i in (([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])):
        assert lexical.search(prepare(spark).createDataFrame(d, docs), spark.createDataFrame(i, items)).collect() == []
