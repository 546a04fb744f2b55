import random
import re
from collections import Counter

import pytest

from callweave.llm import divergence
from callweave.llm._shared import prepare


def brute(rows):
    """Every group against every other and every term, in Python integers."""
    split = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in split}:
        held = Counter(t for a, _, w in split if a == lang for t in set(w))
        kept = [t for t, n in held.items() if n >= 3]
        groups = {s: Counter() for a, s, _ in split if a == lang}
        for a, s, w in split:
            if a == lang:
                groups[s].update(t for t in w if t in set(kept))
        unit = lambda counts: {t: 1 + 10**9 * (counts[t] + 1) // (sum(counts.values()) + len(kept)) for t in kept}
        p = {s: unit(c) for s, c in groups.items()}
        q = unit(sum(groups.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s, c in groups.items():
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            words = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if c[t] > 0 and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(words)[:200])]
    return sorted(out)


def corpus(seed=5):
    r = random.Random(seed)
    alphabet = ["a", "b", "ab", "é", "éa", "日本", "𝒳", "Z", "zz"]
    word = lambda: "".join(r.choice(alphabet) for _ in range(r.randint(1, 4)))
    rows = [(" ".join(word() for _ in range(r.randint(0, 60))), r.choice(["x", "y", "", None]), r.choice(["s1", "s2", "s3", "é", None])) for _ in range(300)]
    rows += [(None, "x", "only null"), ("", "z", "a"), ("1 2 3", "z", "b"), (None, "w", None), ("tie tae toe", "t", "a"), ("tie tae toe", "t", "a"), ("tie tae toe", "t", "b"), ("long " * 50_000 + "tail", "x", "s1")]
    return rows


@pytest.mark.parametrize("leaves,cells,groups,most", [(200_000, 1 << 20, 200_000, 200), (7, 12, 3, 200)])
def test_matches_brute_force(spark, monkeypatch, leaves, cells, groups, most):
    for name, value in (("LEAVES", leaves), ("CELLS", cells), ("GROUPS", groups), ("PARTS", 2)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    docs = prepare(spark).createDataFrame([(*r, 1, "v") for r in rows], "text string, lang string, source string, rank int, value string").repartition(5)
    got = divergence.audit(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_a_third_of_all_terms_below_one_prefix(spark):
    rows = [(" ".join(f"common{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{j}" if k % 3 else f"w{chr(97 + k % 26)}" for k in range(i, i + 40)), "x", f"s{j}") for i in range(0, 400, 10) for j in range(3)]
    got = divergence.audit(prepare(spark).createDataFrame(rows, "text string, lang string, source string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_trie_walks_in_the_order_of_bytes():
    r = random.Random(1)
    words = list({bytes(r.choice([97, 98, 195, 169, 255]) for _ in range(r.randint(1, 6))) for _ in range(3000)})
    walked = list(divergence.Trie(words).walk())
    assert [t for t, _ in walked] == sorted(words) and all(words[k] == t for t, k in walked)


def test_probability_is_exact_beyond_64_bit_products():
    import numpy as np

    for count, total in ((0, 1), (10**13, 10**14), (2 * 10**14, 2 * 10**14 + 1), (5, 7), (10**10, 3 * 10**13 + 1)):
        assert divergence._probability(np.array([count]), total)[0] == 1 + 10**9 * (count + 1) // total


def test_empty_table(spark):
    assert divergence.audit(prepare(spark).createDataFrame([], "text string, lang string, source string")).collect() == []


def test_long_texts_many_groups_and_odd_bytes_are_counted_piece_by_piece(spark, monkeypatch):
    for name, value in (("LEAVES", 9), ("COUNTERS", 12), ("PIECE", 40), ("TEXTS", 3), ("PIECES", 2)):
        monkeypatch.setattr(divergence, name, value)
    r = random.Random(2)
    rows = [(" ".join(r.choice("aBcé日") * r.randint(1, 4) for _ in range(r.choice([0, 3, 60]))), r.choice("xy"), f"s{r.randint(0, 20)}") for _ in range(120)]
    rows += [("q" * 100 + " 1 " + "q" * 100, "x", "s1"), (" " * 200, "x", "blank"), ("[É]\x7f@`{|A" * 9, "y", "s2"), (None, "y", None), ("", "", "")]
    got = divergence.audit(prepare(spark).createDataFrame(rows, "text string, lang string, source string").repartition(2))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_terms_below_one_prefix_split_a_node():
    words = [b"a" * k for k in range(1, 400)] + [b"aaab%d" % k for k in range(500)] + ["日".encode(), b"", b"ab"]
    random.Random(4).shuffle(words)
    trie = divergence.Trie(words)
    assert [t for t, _ in trie.walk()] == sorted(words)
    assert any(isinstance(node, tuple) for node in trie.stems.values())


def test_a_trie_costs_little_more_than_sorting_its_terms():
    from time import process_time

    r = random.Random(6)
    words = list({bytes(r.choices(b"abcdefghijklmnopqrstuvwxyz", k=r.randint(4, 9))) for _ in range(150_000)})

    def least(job):
        took = []
        for _ in range(3):
            began = process_time()
            job()
            took.append(process_time() - began)
        return min(took)

    assert least(lambda: list(divergence.Trie(words).walk())) < 6 * least(lambda: sorted(words))
