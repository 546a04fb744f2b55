import random
import re
from collections import Counter

from callweave.llm import quality


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def verdict(text):
    n, chars, symbols, dup, covered, failed = base(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    adjacent = sum(a == b for a, b in zip(words, words[1:], strict=False))
    upper, lower = len(re.findall("[A-Z]", text or "")), len(re.findall("[a-z]", text or ""))
    return not (failed or 10 * symbols > n or chars < 2 * n or chars > 14 * n or 2 * dup > len(lines) or upper > lower or 10 * adjacent > 3 * n)


def texts():
    r = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "#", "I", "é\xa0ü", "THE"]
    out = [None, "", " \n\t\x0b\x0c\r ", "one two three four five six seven eight nine ten eleven", "A B C D E F G H I J K L", "go go go go go go stop and wait for it"]
    for _ in range(250):
        sep = [" ", " ", "\n", "  ", "\t"]
        t = "".join(r.choice(words[: r.randint(2, 10)]) + r.choice(sep) for _ in range(r.randint(1, 90)))
        out.append(t + t[: r.randint(0, len(t))] if r.random() < 0.3 else t)
    return out + ["long text " * 30_000]


def test_columns_and_verdicts_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "x y")]
    docs = spark.createDataFrame([(*r, True, 5) for r in rows], "doc_id long, text string, kept boolean, n_words int")
    got = {r["doc_id"]: r for r in quality.judge(docs.drop("kept", "n_words")).collect()}
    for doc_id, text in rows:
        g = got[doc_id]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == base(text), repr(text)[:200]
        assert g["kept"] == verdict(text)


def test_order_of_rules_never_changes_the_verdict(spark):
    docs = spark.createDataFrame(list(enumerate(texts()[:60])), "doc_id long, text string")
    a = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    b = {r["doc_id"]: r["kept"] for r in quality.judge(docs, tuple(reversed(quality.RULES)), 5).collect()}
    assert a == b


def test_ranking_and_empty_table(spark):
    docs = spark.createDataFrame(list(enumerate(texts()[:60])), "doc_id long, text string")
    ranked = quality.rank_rules(docs)
    gains = [share / max(cost, 1e-12) for _, share, cost in ranked]
    assert gains == sorted(gains, reverse=True) and {r.name for r, _, _ in ranked} == {r.name for r in quality.RULES}
    assert quality.judge(docs.limit(0)).count() == 0
