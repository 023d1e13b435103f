"""The corpus pipeline stage by stage, and every registered query once."""

import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from monthwise.llm import entries, line_dedup, toxicity
from monthwise.llm.bpe import byte_bpe_path
from monthwise.llm.common import read_table

from .helpers import dedup_lines, documents, fingerprint, link_components

SMALL = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    assert set(entries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontaminate", "bpe"]


@pytest.mark.parametrize("name", sorted(entries.QUERIES))
def test_queries_run_and_repeat(spark, name):
    """Each gives a row per document or its own shape, twice the same."""
    once, again = (entries.QUERIES[name](spark, SMALL).collect() for _ in range(2))
    assert sorted(map(str, once)) == sorted(map(str, again))
    if name not in ("op4_decontaminate", "op8_topk", "op11_spelling", "op13_collocations"):
        assert len(once) == read_table(spark, SMALL, "documents").count()


@pytest.mark.parametrize("name", sorted(entries.ORACLE))
def test_oracles_agree(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cursor = con.execute(entries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    got = entries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))


def test_stages_against_brute_force(spark, scratch):
    """Each stage on all that its predecessor kept."""
    docs, kept = read_table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs, stage(spark, docs, SMALL)
        path = scratch(name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        rows = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        if name != "bpe":
            assert docs.columns == before.columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
        if name == "toxicity":
            model = toxicity.fit_on_tables(spark, SMALL)
            ids = sorted(rows)
            scores = model.scores([rows[i] or "" for i in ids])
            assert kept[-1] == {i: rows[i] for i, s in zip(ids, scores) if s < 0.5}
        elif name == "line_dedup":
            assert kept[-1] == dedup_lines(sorted(rows.items()), line_dedup.MIN_CHARS)
        elif name == "near_duplicates":
            roots = set(link_components({i: fingerprint(t) for i, t in rows.items()}).values())
            assert kept[-1] == {i: rows[i] for i in roots}
        elif name == "decontaminate":
            items = [r.text for r in read_table(spark, SMALL, "benchmark").collect()]
            held = {i for i, t in rows.items() if any(x in t for x in items)}
            assert not held & set(kept[-1]) and set(rows) - set(kept[-1]) == held
    library = Tokenizer.from_file(byte_bpe_path())
    out = docs.collect()
    assert {r.doc_id: r.decoded for r in out} == kept[-1]
    for r in out[:50]:
        assert list(r.ids) == library.encode(r.decoded, add_special_tokens=False).ids
    whole = corpus_pipeline.run(spark, SMALL).collect()
    digest = lambda rs: sorted((r.doc_id, hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()) for r in rs)
    assert digest(whole) == digest(out)


def test_stages_on_odd_rows(spark, scratch):
    same = "a line that is quite long and stands twice here\nand a second line of that kind, also long"
    rows = [(1, same), (1, same), (2, None), (3, ""), (None, "a text of its own without an id but with words"), (4, "w" * 60_000), (5, same)]
    docs = documents(spark, rows, "score predicted _uid _h _gone _fp c0 note")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.columns == docs.columns and empty.count() == 0
        path = scratch(name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    # of the first text one row is left with it or none; null, empty and emptied
    # texts have fingerprint zero and are one group
    left = {(r.doc_id, (r.text or "")[:6]) for r in docs.collect()}
    assert (4, "wwwwww") in left and (None, "a text") in left
    assert len(left) == docs.count() == 4
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 4
