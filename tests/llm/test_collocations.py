"""Phrase collocations against counts by definition."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthwise.llm import collocations as co

from .helpers import documents


def brute(docs, least=10, cover=50, top=2000):
    """docs: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        kept = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in kept.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= cover * a for q, b in kept.items()):
                continue
            cuts = [(1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, n=60, words=12):
    rng = random.Random(seed)
    vocab = ["The", "of", "NEW", "york", "é", "È", "x-y", " a", "日本", "a'b", "𝒶", "zz"][:words]
    glue = [" ", " ", " ", "  ", "\t", ". ", ",", ":\n", " ? ", "\r"]
    return [
        (rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocab) + rng.choice(glue) for _ in range(rng.randint(0, 120))))
        for _ in range(n)
    ]


def frame(spark, docs, extra=""):
    return documents(spark, [(i, text, lang, None, 0) for i, (lang, text) in enumerate(docs)], extra)


def rows(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("tokens, slots", [(4_000_000, 1 << 25), (150, 1 << 25), (40, 64)])
def test_equals_definition(spark, monkeypatch, tokens, slots):
    # small shards: sums over many; few slots: many wrong "can be"
    monkeypatch.setattr(co, "SHARD_TOKENS", tokens)
    monkeypatch.setattr(co, "SLOTS", slots)
    docs = corpus(tokens)
    assert rows(co.collocations(frame(spark, docs, "n g1 word").repartition(3))) == brute(docs)


def test_top_and_ties(spark):
    docs = corpus(3, 90, 5)
    want = [r for r in brute(docs) if r[1] <= 4]
    assert rows(co.collocations(frame(spark, docs), top=4)) == want


def test_long_text_is_cut_at_borders(monkeypatch):
    monkeypatch.setattr(co, "STEP_BYTES", 10)
    text = "Aa bb cc. " * 50 + "one piece without an end " * 5
    got = [w for words in co.steps(text) for w in words]
    want = [x for p in re.split("[.]", text.lower().replace("\n", "")) for x in [*(w.encode() for w in p.split()), co.BORDER]]
    squeeze = lambda ws: [w for i, w in enumerate(ws) if w != co.BORDER or (i and ws[i - 1] != co.BORDER)]
    assert squeeze(got) == squeeze(want)


def test_overlaps_nulls_and_long_texts(spark):
    docs = [("en", "ha " * 50_000), ("en", None), ("en", ""), ("en", "..;!"), (None, "ha ha " * 20), ("xx", "a b")]
    assert rows(co.collocations(frame(spark, docs))) == brute(docs)


def test_empty_table(spark):
    assert rows(co.collocations(frame(spark, []))) == []


def test_counts_beyond_64_bits(spark):
    a, left, right = 4 * 10**12, 5 * 10**12, 9 * 10**12
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.selectExpr(co._score("a", "l", "r")).first()[0] == 1000000 * a * a // (left * right)


def test_index_counts_every_phrase():
    rng = np.random.default_rng(2)
    text = np.concatenate([[0], rng.integers(0, 6, 3000)]).astype(np.int32)
    fm = co.FmIndex.of(text)
    pairs = Counter((a, b) for a, b in zip(text, text[1:]) if a and b)
    assert {(a, b): n for a, b, n in zip(fm.firsts, fm.seconds, fm.sizes)} == pairs
    triples = Counter((a, b, c) for a, b, c in zip(text, text[1:], text[2:]) if a and b and c)
    symbols = np.arange(6)
    x, y, z, n = fm.extend_left(symbols, lambda a, b: np.ones(len(a), bool))
    assert dict(zip(zip(x, y, z), n)) == triples
    x, y, z, n = fm.extend_left(symbols, lambda a, b: a != 3)
    assert dict(zip(zip(x, y, z), n)) == {t: c for t, c in triples.items() if t[0] != 3 and t[1] != 3}
