"""Language identification and toxicity: held-out accuracy, and odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from monthwise.llm import langid, toxicity
from monthwise.llm.common import crc_fold, fold, read_table

from .helpers import documents

SF, SF_MID = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_fold_is_crc32_of_the_id_as_text(spark):
    ids = [0, 7, 123456789, -5]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", fold(F.col("doc_id"), 5).alias("f")).collect()
    assert {r.doc_id: r.f for r in got} == {i: crc_fold(i, 5) for i in ids}


def test_parse_is_the_greedy_cross_parse():
    """Phrase counts against a parse by substring search."""
    rng = random.Random(1)
    samples = {"x": ["".join(rng.choice("abcd") for _ in range(300))], "y": ["".join(rng.choice("abde") for _ in range(200))]}
    model = langid.CrossParser(samples)
    texts = ["".join(rng.choice("abcdez") for _ in range(rng.randint(1, 240))) for _ in range(50)]
    got = model.phrases(texts)
    for k, language in enumerate(model.languages):
        sample = samples[language][0]
        for t, n in zip(texts, got[:, k]):
            at = count = 0
            while at < len(t):
                end = at + 1
                while end <= len(t) and t[at:end] in sample:
                    end += 1
                at, count = max(end - 1, at + 1), count + 1
            assert n == count, (t, language)


def test_language_accuracy_on_held_out_rows(spark):
    out = langid.op1_langid(spark, SF).join(read_table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").collect()
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_odd_rows(spark):
    english = ["the cat sat on the mat and the dog ran", "a dog and a cat ran over the mat"]
    german = ["der hund und die katze sind auf der matte", "die katze sitzt und der hund rennt"]
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the dog"), (4, "the dog"), (None, "die katze"), (5, "the cat " * 20_000)]
    docs = documents(spark, rows, "lang_pred score _text")
    out = langid.identify(docs, {"en": english, "de": german}).collect()
    by = {(r.doc_id): r for r in out}
    assert len(out) == 7 and [by[i].lang_pred for i in (1, 2, 3, 4, None, 5)] == ["und", "und", "und", "en", "de", "en"]
    assert by[1].score == 0 and by[5].score > 0.99
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), {"en": english}).count() == 0
    assert langid.sample_pieces(docs) == {}


def test_sample_counts_copies_once(spark):
    rows = [(i, "same text here", "en", "s", 1) for i in range(50)] + [(99, "another one", "en", "s", 1), (100, "ein satz", "de", "s", 1)]
    got = langid.sample_pieces(documents(spark, rows), pieces=60)
    assert sorted(got["en"]) == ["another one", "same text here"] and got["de"] == ["ein satz"]


def test_sample_is_whole_beside_many_copies(spark):
    rows = [(i, f"hot text {'abcdefghij'[i % 10]}", "en", "s", 1) for i in range(8000)] + [(1, "ein satz", "de", "s", 1)]
    rows += [(i, "one hot text", "fr", "s", 1) for i in range(4000)] + [(i, f"rare text number {i}", "fr", "s", 1) for i in range(60)]
    got = langid.sample_pieces(documents(spark, rows), pieces=12)
    assert {k: len(v) for k, v in got.items()} == {"en": 10, "de": 1, "fr": 12}
    assert len(set(got["en"])) == 10 and len(set(got["fr"])) == 12


def toxic_corpus(n=240):
    rng = random.Random(3)
    words = ["".join(rng.choice(["an", "re", "to", "li", "es", "mo"]) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    texts, toxic = [], []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            for _ in range(5):
                t.insert(rng.randrange(len(t)), rng.choice(["zzyrk", "quabble", "vexx"]))
        texts.append(" ".join(t))
        toxic.append(i % 3 == 0)
    return texts, toxic


def test_toxicity_separates_and_keeps_clean_text():
    texts, toxic = toxic_corpus()
    model = toxicity.CompressionDistance(texts[:160], toxic[:160])
    scores = model.scores(texts[160:])
    right = (scores >= 0.5) == np.array(toxic[160:])
    assert right.mean() > 0.95
    assert model.scores([""])[0] < 0.5


def test_toxicity_on_held_out_rows(spark):
    labels = read_table(spark, SF_MID, "labels")
    out = toxicity.op6_toxicity(spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    positive = [r.score for r in out if r.toxic == 1]
    negative = [r.score for r in out if r.toxic == 0]
    auc = np.mean([[1.0 if p > q else 0.5 if p == q else 0.0 for q in negative] for p in positive])
    assert auc > 0.88 and np.mean([q < 0.5 for q in negative]) > 0.95


def test_toxicity_odd_rows(spark):
    texts, toxic = toxic_corpus()
    model = toxicity.CompressionDistance(texts, toxic)
    rows = [(1, None), (2, ""), (None, texts[0]), (3, texts[0]), (3, texts[0]), (4, "w" * 50_000), (5, texts[1])]
    docs = documents(spark, rows, "score predicted c0 _scored_text")
    out = toxicity.score(docs, model, {"doc_id": F.col("doc_id")}).collect()
    assert [r.predicted for r in out] == [0, 0, 1, 1, 1, 0, 0]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    none = toxicity.CompressionDistance(["a"], [False])
    assert toxicity.drop_toxic(docs, none).count() == 7
    assert toxicity.drop_toxic(docs.limit(0), model).count() == 0


def test_fit_skips_null_and_other_folds(spark):
    docs = documents(spark, [(1, "a b c"), (2, None), (3, "d e f")])
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, labels, F.lit(True)).members == []  # one labelled text: no classifier
    assert toxicity.fit(docs, labels.limit(0), F.lit(True)).members == []
