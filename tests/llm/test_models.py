"""Language and toxicity models: exactness where there is a definition, held-out accuracy where there is none."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from callweave.llm import langid, toxicity
from callweave.llm._shared import prepare

SYLLABLES = {"aa": ["ka", "to", "mi", "ru", "se"], "bb": ["schl", "ung", "eit", "der", "ich"], "cc": ["при", "вет", "дом", "она"]}


def word(r, lang):
    return "".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4)))


def corpus(n=400):
    r = random.Random(1)
    rows = []
    for k in range(n):
        lang = r.choice(list(SYLLABLES))
        rows.append((k, " ".join(word(r, lang) for _ in range(r.randint(5, 60))), lang))
    return rows


def test_viterbi_is_the_best_labelling():
    r = np.random.default_rng(2)
    for _ in range(40):
        scores = r.normal(0, 3, (6, 3))
        value = lambda path, s=scores: sum(s[k, x] for k, x in enumerate(path)) - 2.5 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        best = max(value(p) for p in itertools.product(range(3), repeat=6))
        assert abs(value(langid.viterbi(scores, 2.5).tolist()) - best) < 1e-9


def test_texts_that_skip_the_recursion_have_the_same_labels():
    r = np.random.default_rng(3)
    for _ in range(60):
        scores = r.normal(0, 2, (12, 3)) + np.array([1.5, 0, 0])
        best = scores.sum(0).argmax()
        gain = langid._gains(scores, np.array([best]), np.array([0]), np.array([12]))[0]
        if gain <= langid.SWITCH / 2:
            assert (langid.viterbi(scores) == best).all()


def test_language_accuracy_spans_and_edges(spark):
    prepare(spark)
    rows = corpus()
    r = random.Random(9)
    mixed = " ".join([word(r, "aa") for _ in range(20)] + [word(r, "bb") for _ in range(30)])
    rows += [(9000, None, "aa"), (9001, "", None), (9002, "123 -- !", "bb"), (None, rows[0][1], "aa"), (9003, mixed, None), (9004, "ελληνικά", None), (0, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame([(*x, True, 1.0) for x in rows], "doc_id long, text string, lang string, held_out boolean, score double")
    got = [x.asDict() for x in langid.identify(docs).collect()]
    assert len(got) == len(rows)
    by = {g["doc_id"]: g for g in got}
    for doc_id, _, lang in rows[:400]:
        assert by[doc_id]["lang_pred"] == lang
        assert by[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
    assert [(by[k]["lang_pred"], by[k]["score"]) for k in (9000, 9001, 9002)] == [("und", 0.0)] * 3
    assert by[9003]["spans"] == "aa:0:20,bb:20:50" and 0.3 < by[9003]["score"] < 1
    assert by[9004]["lang_pred"] in SYLLABLES and by[None]["held_out"] is False
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4  # three without letters, one in an unlearned script
    assert langid.identify(docs.limit(0)).count() == 0
    assert {x["lang_pred"] for x in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_labels_outside_the_learned_fold_change_nothing(spark):
    docs = prepare(spark).createDataFrame(corpus(200), "doc_id long, text string, lang string")
    spoiled = docs.withColumn("lang", F.when(langid.fold("doc_id", 4) == 2, "zz").otherwise(F.col("lang")))
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(d).collect()} for d in (docs, spoiled))
    assert a == b


def test_words_of_any_length_score_as_their_letters_say():
    model = langid.Model(["x", "y"], np.zeros((2, langid.BUCKETS), np.float32), np.zeros((2, langid.BUCKETS), np.float32), np.ones((len(langid.NAMES) + 2, 2), bool))
    assert langid.label(pa.array(["a" * 100_000, None, "1"]), model) == [("x", 1.0, [("x", 0, 1)]), ("und", 0.0, []), ("und", 0.0, [])]


def toxic_corpus(n=700):
    r = random.Random(4)
    usual = [word(r, "aa") for _ in range(600)]
    rude = ["grobian", "dumbolt", "wretchling"]
    docs, labels = [], []
    for k in range(n):
        words, toxic = [r.choice(usual) for _ in range(r.randint(30, 120))], int(r.random() < 0.25)
        for _ in range(toxic * r.randint(2, 5)):
            words.insert(r.randrange(len(words)), r.choice(rude))
        docs.append((k, " ".join(words)))
        labels.append((k, toxic))
    return docs, labels


def test_toxicity_held_out_accuracy_and_edges(spark):
    prepare(spark)
    docs, labels = toxic_corpus()
    truth = dict(labels)
    rows = [*docs, (9000, None), (9001, ""), (None, docs[0][1]), docs[1]]
    frame = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, (None, 1), (9000, None)], "doc_id long, toxic int")
    got = [x.asDict() for x in toxicity.predict(frame, toxicity.train(frame, known)).collect()]
    assert len(got) == len(rows)
    held = [g for g in got if g["held_out"]]
    right = sum(g["predicted"] == truth[g["doc_id"]] for g in held if g["doc_id"] in truth)
    assert right >= 0.97 * len(held) and len(held) > 80
    assert all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5) for g in got)
    by = {g["doc_id"]: g for g in got}
    assert by[9000]["score"] == by[9001]["score"] < 0.5 and by[None]["held_out"] is False
    assert toxicity.predict(frame.limit(0), None).count() == 0
    assert {x["score"] for x in toxicity.predict(frame, toxicity.train(frame, known.limit(0))).collect()} == {0.0}


def test_toxicity_does_not_learn_from_the_held_out_fold(spark):
    docs, labels = toxic_corpus(300)
    frame, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = known.withColumn("toxic", F.when(langid.fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(frame, known) == toxicity.train(frame, flipped)


def test_spans_inside_unspaced_scripts(spark):
    r = random.Random(7)
    han, kana = "天地玄黄宇宙洪荒", "いろはにほへとちりぬる"
    rows = [(k, "".join(r.choice((han, kana)[k % 2]) for _ in range(80)), ("zh", "ja")[k % 2]) for k in range(120)]
    rows.append((900, "".join(r.choice(han) for _ in range(40)) + "".join(r.choice(kana) for _ in range(60)), None))
    got = {x["doc_id"]: x for x in langid.identify(prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k]["lang_pred"] == lang for k, _, lang in rows[:-1])
    assert got[900]["spans"] == "zh:0:10,ja:10:25" and got[900]["lang_pred"] == "ja"


def test_only_languages_of_a_words_script_are_scored():
    model = langid.Model(["x", "y"], np.zeros((2, langid.BUCKETS), np.float32), np.zeros((2, langid.BUCKETS), np.float32), np.zeros((len(langid.NAMES) + 2, 2), bool))
    model.allowed[2 + langid.NAMES.index("latin"), 0] = model.allowed[2 + langid.NAMES.index("cyrillic"), 1] = True
    model.trigrams[0] -= 1
    scores, _ = langid.word_scores(langid._words(["abc", "где", "日本"]), model)
    assert scores[0, 1] == scores[0, 0] - langid.WRONG_SCRIPT and scores[1, 0] == scores[1, 1] - langid.WRONG_SCRIPT and not scores[2].any()


def test_toxicity_of_long_texts_and_ties(spark):
    docs, labels = toxic_corpus()
    frame = prepare(spark).createDataFrame([*docs, (9000, " ".join(t for _, t in docs) * 3), (9001, "x" * 2_000_000), (9002, docs[0][1]), (9003, docs[0][1])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.predict(frame, toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()}
    assert got[9000]["predicted"] == 1 and got[9001]["predicted"] == 0 and got[9002]["score"] == got[9003]["score"] == got[0]["score"]


def test_dictionaries_hold_their_classes_language():
    docs, labels = toxic_corpus()
    model = toxicity.fit(sorted((t, dict(labels)[k]) for k, t in docs))
    assert b"grobian" in model.toxic and b"grobian" not in model.ordinary
    gains = toxicity.Gains(model.ordinary, model.toxic)
    usual = docs[0][1].lower().encode().split()[:7]
    assert gains.of([[*usual, b"wretchling"]])[0] > max(2, gains.of([usual])[0])
