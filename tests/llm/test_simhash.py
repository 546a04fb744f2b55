import random
import re

import numpy as np
import pytest
import xxhash

from callweave.llm import registry, simhash
from callweave.llm._shared import prepare

DATA = "/root/testdata/sf0.001"


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(pairs):
    """(id, print) -> component of each print: all pairs compared, smallest id reachable."""
    least = {}
    for d, p in pairs:
        least[p] = min(d, least.get(p, d))
    prints = list(least)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    values = np.array(prints, np.uint64)
    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 4):
            root[find(p)] = find(prints[j])
    out = {}
    for p in prints:
        out[find(p)] = min(least[p], out.get(find(p), least[p]))
    return {p: out[find(p)] for p in prints}


def test_query_matches_brute_force(spark):
    docs = prepare(spark).read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_print(r["text"]) for r in docs}
    want = brute(list(prints.items()))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.op13_simhash_components(spark, DATA).collect()}
    assert got == {d: (f"{p:016x}", want[p]) for d, p in prints.items()}


def near(seed, families, size, noise):
    """Prints in families: each member some bits off its family's first."""
    r = random.Random(seed)
    out = []
    for _ in range(families):
        base = r.getrandbits(64)
        for _ in range(size):
            p = base
            for _ in range(r.randint(0, noise)):
                p ^= 1 << r.randrange(64)
            out.append(p)
    return out


@pytest.mark.parametrize("named_by,longest", [(2, 2_048), (3, 2_048), (4, 2_048), (2, 8), (4, 5)])
def test_every_naming_and_long_postings(spark, monkeypatch, named_by, longest):
    monkeypatch.setattr(simhash, "LIST", longest)
    monkeypatch.setattr(simhash, "GATHERED", 100)
    monkeypatch.setattr(simhash, "positions_for", lambda n: named_by)
    prints = near(1, 60, 6, 5) + near(2, 3, 80, 4) + near(3, 1, 60, 9)
    table = [(k, p) for k, p in enumerate(prints)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs.select("doc_id", "print"))
    signed = [(k, p - (1 << 64) if p >> 63 else p) for k, p in table]
    got = simhash.components(prepare(spark).createDataFrame(signed, "doc_id long, print long").repartition(4))
    want = brute(table)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {k: want[p] for k, p in table}


def test_positions_grow_with_the_entries():
    assert [simhash.positions_for(n) for n in (0, 64 * 256**2, 64 * 256**2 + 1, 64 * 256**3 + 1)] == [2, 2, 3, 4]


def test_edge_rows(spark):
    long = " ".join(f"x{k % 977}y{k % 31}" for k in range(70_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one"), (7, long), (8, long + " z"), (9, "a b c d e"), (9, "p q r s t"), (10, "P q R s t"), (None, "a b c d e"), (11, "a\xa0b é 日本 x"), (11, "a\xa0b é 日本 x"), (12, "w " * 300)]
    docs = prepare(spark).createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, print long, component_id string")
    got = simhash.components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [plain_print(t) for _, t in rows]
    want = brute([(d, p) for (d, _), p in zip(rows, prints, strict=True) if d is not None])
    expected = [(d, f"{p:016x}", None if d is None else want[p]) for (d, _), p in zip(rows, prints, strict=True)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert simhash.components(docs.limit(0)).collect() == []
