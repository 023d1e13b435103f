"""Mixing: targets by the rule of resharing, exact quotas, the splitting tree."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.llm import mixing

from .helpers import documents


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    """The rule as stated: shares by weight, stop at the cap, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    got = {s: total * w[s] / sum(w.values()) for s in order}
    while any(got[s] > most * sizes[s] + 1e-9 for s in order):
        full = {s for s in order if got[s] >= most * sizes[s] - 1e-9}
        excess = sum(got[s] - most * sizes[s] for s in full)
        free = sum(w[s] for s in order if s not in full)
        for s in order:
            got[s] = most * sizes[s] if s in full else got[s] + excess * w[s] / free
    return got


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed, n=120):
    rng = random.Random(seed)
    sources = ["a", "a", "a", "a", "Z", "é", "b", None, "src10", "src9"]
    docs = []
    for i in range(n):
        size = rng.choice([0, 1, 3, 40, 200, 900])
        text = rng.choice([None, ""]) if size == 0 else " x \t".join(f"w{i}_{j}" for j in range(size))
        docs.append((i, text, None, rng.choice(sources), 0))
    return docs


def check(docs, rows, mix):
    size = Counter()
    for d in docs:
        size[d[3]] += len(words(d[1]))
    want = targets(dict(size))
    took, blocks = defaultdict(Counter), defaultdict(Counter)
    for m in mix:
        took[m.source][m.row] += m.n_words
        blocks[(m.row, m["pass"])][m.first_word] += 1
    assert len(rows) == len(docs)
    by_row = {r.row: r for r in rows}
    for r in rows:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
    for source, t in want.items():
        assert sum(took[source].values()) == round(t)
    for c in took.values():
        for row, n in c.items():
            assert n <= 2 * by_row[row].size
    # a block is drawn at most once a pass
    assert all(n == 1 for c in blocks.values() for n in c.values())


@pytest.mark.parametrize("block, bucket, shard", [(512, 4096, 8192), (16, 4, 10), (7, 1, 3)])
def test_quotas_are_exact(spark, monkeypatch, block, bucket, shard):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    monkeypatch.setattr(mixing, "BUCKET_BLOCKS", bucket)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", shard)
    docs = corpus(block)
    rows, mix = mixing.mix_sources(documents(spark, docs, "row sid target"))
    mix = mix.persist()
    got = mix.collect()
    check(docs, rows.collect(), got)
    # shards are of equal size, and their places are 0, 1, 2, ...
    places = defaultdict(list)
    for m in got:
        places[m.shard].append(m.position)
    sizes = [len(p) for p in places.values()]
    assert max(sizes) - min(sizes) <= 1 and max(sizes) <= shard
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # the texts are those words
    text = {d[0]: words(d[1]) for d in docs}
    out = mixing.mixed_texts(documents(spark, docs), mix).collect()
    assert len(out) == len(got)
    for r in out:
        assert r.text.split(" ") == text[r.doc_id][r.first_word : r.first_word + r.n_words]
    again = mixing.mix_sources(documents(spark, docs[::-1]).repartition(5))[1]
    strip = lambda rs: sorted(tuple(m[c] for c in ("shard", "position", "doc_id", "pass", "first_word", "n_words")) for m in rs)
    assert strip(again.collect()) == strip(got)


def test_sources_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    docs = corpus(77)
    rows, mix = mixing.mix_sources(documents(spark, docs))
    check(docs, rows.collect(), mix.collect())


def test_tree_keeps_every_quota_and_its_law():
    quotas = {1: 5000, 2: 300, 3: 1, 4: 4699}
    rows = list(mixing.leaves(quotas, 100, 0, 100, seed=4))
    for sid, n in quotas.items():
        runs = sorted((first, first + m) for _, s, first, m in rows if s == sid)
        assert runs[0][0] == 0 and runs[-1][1] == n and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    assert set(Counter({s: sum(m for t, _, _, m in rows if t == s) for s in range(100)}).values()) == {100}
    # tasks that see a part of the shards agree with the whole
    assert [r for r in rows if 30 <= r[0] < 47] == list(mixing.leaves(quotas, 100, 30, 47, seed=4))
    # mean and variance of the first shard's share over seeds
    got = np.array([dict((s, m) for _, s, _, m in mixing.leaves(quotas, 100, 0, 1, seed)).get(1, 0) for seed in range(2000)])
    assert abs(got.mean() - 50) < 0.5
    assert abs(got.var() - 100 * 0.5 * 0.5 * (9900 / 9999)) < 3


def test_large_populations():
    rng = np.random.default_rng(1)
    total, good = 5 * 10**9, 2 * 10**9
    got = [mixing._drawn(rng, good, total - good, 10**9) for _ in range(300)]
    assert abs(np.mean(got) / (4 * 10**8) - 1) < 1e-4
    few = [mixing._drawn(rng, 10, total, total // 2) for _ in range(500)]
    assert 0 <= min(few) and max(few) <= 10 and abs(np.mean(few) - 5) < 0.4
    part = mixing.split_quotas(rng, {1: good, 2: total - good, 3: 7}, 10**9)
    assert sum(part.values()) == 10**9


def test_repeated_rows_nulls_and_one_hot_source(spark):
    docs = [(1, "a b c", None, "hot", 0)] * 5 + [(None, "x y", None, None, 0)] * 3 + [(i, "w " * 30, None, "hot", 0) for i in range(50)]
    docs += [(7, None, None, "empty", 0), (7, "", None, "empty", 0)]
    rows, mix = mixing.mix_sources(documents(spark, docs))
    check(docs, rows.collect(), mix.collect())


def test_query(spark, tmp_path):
    docs = corpus(5)
    documents(spark, docs, "target taken").write.parquet(f"{tmp_path}/documents.parquet")
    df = mixing.op12_mixing(spark, str(tmp_path))
    assert df.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = {r.doc_id: r for r in df.collect()}
    size = Counter()
    for d in docs:
        size[d[3]] += len(words(d[1]))
    want = targets(dict(size))
    taken = Counter()
    for d in docs:
        assert got[d[0]].size == len(words(d[1])) and got[d[0]].taken <= 2 * got[d[0]].size
        taken[d[3]] += got[d[0]].taken
    assert taken == {s: round(t) for s, t in want.items() if s in taken}
    (tmp_path / "none").mkdir()
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert mixing.op12_mixing(spark, f"{tmp_path}/none").collect() == []


def test_very_long_text(spark):
    docs = documents(spark, [(1, None, None, "a", 0), (2, "w " * 200_000, None, "b", 0)])
    rows, mix = mixing.mix_sources(docs)
    assert mix.agg(F.sum("n_words")).first()[0] == 300_000
