"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from monthwise.llm import spelling

from .helpers import documents


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(words: dict, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def random_words(seed, n, letters="abcdé", lengths=(3, 7)):
    rng = random.Random(seed)
    out = {}
    while len(out) < n:
        out["".join(rng.choice(letters) for _ in range(rng.randint(*lengths)))] = rng.choice([1, 2, 5, 20, 300, 4000])
    return out


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("cell, chunk", [(4096, 16384), (20, 7)])
def test_equals_comparing_all_words(spark, monkeypatch, cell, chunk):
    # small cells: many upper cells; small chunks: cells dealt in parts
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "CHUNK_WORDS", chunk)
    words = random_words(3, 600)
    assert result(spelling.group_variants(frame(spark, words))) == brute(words)


def test_sample_smaller_than_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 150)
    monkeypatch.setattr(spelling, "CELL_WORDS", 10)
    words = random_words(5, 500)
    assert result(spelling.group_variants(frame(spark, words))) == brute(words)


def test_words_of_equal_letters_and_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK_WORDS", 50)
    rng = random.Random(1)
    anagrams = {"".join(rng.sample("abcdefgh", 8)): 3 for _ in range(300)}
    long = "ab" * 400
    words = {**anagrams, "abcdefg": 100, long: 50, long[:-1]: 2, "x" + long[1:]: 1, "𝒶𝒷𝒸": 2, "𝒶𝒷𝒹": 30, "q": 1, "z": 9}
    assert result(spelling.group_variants(frame(spark, words))) == brute(words)


def test_chain_and_ties(spark):
    words = {"aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaabb": 100, "aaaaabbb": 1000, "aaaabbbb": 10000, "zaaaabbbb": 10000}
    got = result(spelling.group_variants(frame(spark, words)))
    assert got == brute(words)
    assert got["aaaaaaaa"][1] == "aaaabbbb"
    tie = {"casa": 1, "cosa": 20, "cesa": 20}
    assert result(spelling.group_variants(frame(spark, tie)))["casa"][0] == "cesa"


def test_nulls_repeats_empty_extra_columns(spark):
    rows = [("abcdefgh", 2, "x"), ("abcdefgh", 3, "x"), (None, 4, "x"), ("", 4, "x"), ("abcdefg", None, "x"), ("abcdefgx", 50, "x")]
    df = spark.createDataFrame(rows, "word string, n long, form string")
    assert result(spelling.group_variants(df)) == brute({"abcdefgh": 5, "abcdefgx": 50})
    assert spelling.group_variants(df.limit(0)).collect() == []


def noisy(docs):
    c = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                c[run] += 1
    return {w: n for w, n in c.items() if n >= 2}


def test_query_equals_definition(spark, tmp_path):
    rng = random.Random(8)
    stems = ["Überraschung", "señalamiento", "multiplication", "ÉCOLEÀÿ×÷", "kitchens", "kitchen", "Straßenbahn"]
    docs = [(i, " ".join(rng.choice(stems) for _ in range(60)) + f"x{i}") for i in range(80)]
    docs += [(None, "kitchen kitchen"), (500, None), (501, ""), (501, ""), (502, "multiplication," * 3000)]
    documents(spark, docs, "word n form").write.parquet(f"{tmp_path}/documents.parquet")
    got = result(spelling.op11_spelling(spark, str(tmp_path)))
    want = noisy(docs)
    assert len(want) > 15
    assert got == brute(want)


def test_query_on_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.op11_spelling(spark, str(tmp_path)).collect() == []
