"""Mixing sources to target weights, with exact quotas in every output shard.

1. *Targets.*  Sources in code-point order, null last, have the weights in
   turn and share ``share`` times all words; a target stops at ``most`` times
   its source's size and the excess is reshared by weight until none is above.
   Each round is one aggregate over the sources.
2. *Blocks.*  Documents are cut into blocks of ``BLOCK_WORDS`` words.  A
   source's blocks are permuted by hash, once per pass over the source, and
   taken from the front until the target's words are reached; the last block
   is cut there.  Ranks and running sums are exact: the permutation is dealt
   in buckets by the leading bits of the hash, sized to ``BUCKET_BLOCKS``
   blocks, so a source of any size is summed in small groups.
3. *Splitting tree.*  The blocks of all sources are dealt over output shards
   of ``SHARD_BLOCKS`` blocks: a node of the tree holds a range of shards and
   each source's quota of blocks; its left half draws its part of each quota
   from the multivariate hypergeometric law, the right half keeps the rest.
   A node's generator is seeded by the node, so tasks descend from the root
   on their own and agree.  A leaf knows its quotas and, from what went left,
   where they begin.
4. A shard's quota of a source is the run of permuted blocks from there on,
   so shards are disjoint and every block drawn is in one.  The shard's order
   is a hash of the block.

One row a source reaches the driver.  Populations beyond numpy's limit of 10^9
blocks in one node are drawn from the binomial or normal law that the
hypergeometric one tends to; quotas stay exact.

Defined cases: a null or empty text has size 0 and nothing is taken; equal
rows are documents of their own; sources of size 0 have target 0; an empty
table gives no rows; extra columns are ignored.  Reruns agree, as all choices
are hashes of doc_id, size, block and seed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import read_table, shuffle_count, staged
from monthwise.operators.sequence import split_row_number

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 512
BUCKET_BLOCKS = 4_096
SHARD_BLOCKS = 8_192
#: A table of so many sources is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 20_000
#: numpy's generator draws from populations below this.
LARGEST_DRAW = 10**9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, source, size, copy``: a row per document; rows alike in
    these three get copy numbers, as nothing else tells them apart."""
    alike = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    alike = alike.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = alike.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n")
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "mixing/rows")


def source_targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``sid, source, source_size, blocks, target``; ``sid`` counts sources from 1 in their order."""
    blocks = F.ceil(F.col("size") / BLOCK_WORDS)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(blocks).cast("long").alias("blocks"))
    sources = split_row_number(sources, [], [F.col("source").isNull(), F.col("source")], "sid")
    turn = F.array(*[F.lit(w) for w in weights])[F.pmod(F.col("sid") - 1, F.lit(len(weights))).cast("int")]
    sources = staged(sources.withColumn("weight", turn).withColumn("cap", F.col("source_size") * most), "mixing/sources")
    total, heavy = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return sources.select("sid", "source", "source_size", "blocks", F.lit(0.0).alias("target"))
    rate, before = share * total / heavy, heavy
    while True:
        full = F.col("cap") <= F.lit(rate) * F.col("weight")
        held, free = sources.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if free is None or free == before:  # none above any more
            break
        rate, before = (share * total - held) / free, free
    target = F.least(F.col("cap").cast("double"), F.lit(rate) * F.col("weight"))
    return sources.select("sid", "source", "source_size", "blocks", target.alias("target"))


def _with_sources(df: DataFrame, sources: DataFrame) -> DataFrame:
    few = sources.count() <= BROADCAST_SOURCES
    here = sources.withColumnRenamed("source", "_source")
    here = F.broadcast(here) if few else here
    return df.join(here, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _permuted(rows: DataFrame, seed: int) -> DataFrame:
    """The drawn blocks: ``sid, rank, row, doc_id, source, pass, first_word, n_words, k, h``."""
    quota = F.round("target").cast("long")
    passes = F.ceil(quota / F.col("source_size")).cast("int")
    blocks = (
        rows.where("size > 0")
        .withColumn("quota", quota)
        .where("quota > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / BLOCK_WORDS) - 1)))
    )
    bits = F.greatest(F.ceil(F.log2(F.col("blocks") / BUCKET_BLOCKS)), F.lit(0)).cast("int")
    blocks = blocks.select(
        *["sid", "quota", "row", "doc_id", "source", "pass", "block"],
        F.least(F.lit(BLOCK_WORDS), F.col("size") - F.col("block") * BLOCK_WORDS).alias("words"),
        F.xxhash64(F.lit(seed), "pass", "doc_id", "size", "copy", "block").alias("h"),
        bits.alias("bits"),
    )
    # unsigned leading bits, in two shifts as a shift by 64 is one by 0
    blocks = blocks.withColumn("bucket", F.expr("shiftrightunsigned(shiftrightunsigned(h, 1), 63 - bits)"))
    blocks = blocks.withColumn("region", F.expr("shiftrightunsigned(bucket, bits div 2)"))
    blocks = staged(blocks, "mixing/blocks")

    # running counts and words: of buckets in a region, of regions in a source, of blocks in a bucket
    def before(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    buckets = blocks.groupBy("sid", "pass", "region", "bucket").agg(
        F.count(F.lit(1)).alias("m"), F.sum("words").alias("w")
    )
    inner = before(Window.partitionBy("sid", "pass", "region").orderBy("bucket"))
    outer = before(Window.partitionBy("sid").orderBy("pass", "region"))
    regions = buckets.groupBy("sid", "pass", "region").agg(F.sum("m").alias("m"), F.sum("w").alias("w"))
    regions = regions.select("sid", "pass", "region", F.sum("m").over(outer).alias("om"), F.sum("w").over(outer).alias("ow"))
    zero = F.lit(0)
    starts = (
        buckets.withColumn("im", F.sum("m").over(inner))
        .withColumn("iw", F.sum("w").over(inner))
        .join(regions, ["sid", "pass", "region"])
        .select(
            *["sid", "pass", "bucket"],
            (F.coalesce("im", zero) + F.coalesce("om", zero)).alias("m0"),
            (F.coalesce("iw", zero) + F.coalesce("ow", zero)).alias("w0"),
        )
    )
    starts = staged(starts, "mixing/starts")
    order = Window.partitionBy("sid", "pass", "bucket").orderBy("h", "doc_id", "block", "row")
    placed = blocks.join(starts, ["sid", "pass", "bucket"])
    placed = placed.withColumn("rank", F.col("m0") + F.row_number().over(order) - 1)
    placed = placed.withColumn("at", F.col("w0") + F.coalesce(F.sum("words").over(before(order)), zero))
    left = F.least(F.col("words"), F.col("quota") - F.col("at"))
    return placed.where("at < quota").select(
        *["sid", "rank", "row", "doc_id", "source", "pass"],
        (F.col("block") * BLOCK_WORDS).alias("first_word"),
        left.alias("n_words"),
        "h",
    )


def _drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric: how many of ``n`` drawn from ``good + bad`` are good."""
    total = good + bad
    if not total or not good or not n:
        return 0
    if total < LARGEST_DRAW:
        return int(rng.hypergeometric(good, bad, n))
    p = n / total
    if good < 10**6:
        k = int(rng.binomial(good, p))
    else:
        k = round(rng.normal(good * p, (good * p * (1 - p) * (bad / (total - 1))) ** 0.5))
    return min(max(k, n - bad, 0), good, n)


def split_quotas(rng: np.random.Generator, quotas: dict[int, int], n: int) -> dict[int, int]:
    """Multivariate hypergeometric: ``n`` blocks of those in ``quotas``, by source."""
    rest, part = sum(quotas.values()), {}
    for sid, m in quotas.items():
        rest -= m
        k = _drawn(rng, m, rest, n)
        if k:
            part[sid] = k
        n -= k
    return part


def leaves(quotas: dict[int, int], shards: int, lo: int, hi: int, seed: int) -> Iterator[tuple[int, int, int, int]]:
    """``shard, sid, first rank, blocks`` of the shards ``lo .. hi - 1`` of ``shards``."""
    total = sum(quotas.values())
    todo = [(0, shards, quotas, dict.fromkeys(quotas, 0))]
    while todo:
        a, b, have, first = todo.pop()
        if b <= lo or hi <= a or not have:
            continue
        if b - a == 1:
            yield from ((a, sid, first[sid], n) for sid, n in have.items())
            continue
        mid = (a + b) // 2
        rng = np.random.Generator(np.random.PCG64([seed, a, b]))
        left = split_quotas(rng, have, mid * total // shards - a * total // shards)
        right = {sid: n - left.get(sid, 0) for sid, n in have.items() if n > left.get(sid, 0)}
        todo.append((mid, b, right, {sid: first[sid] + left.get(sid, 0) for sid in right}))
        todo.append((a, mid, left, {sid: first[sid] for sid in left}))


def _leaf_batches(batches, quotas, shards, seed) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()  # a range of shards
        if len(ids):
            rows = list(leaves(quotas, shards, int(ids.min()), int(ids.max()) + 1, seed))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], names=["shard", "sid", "first_rank", "n"]
            )


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(rows, mix).

    rows: ``row, doc_id, source, size, source_size, target``, one per document.
    mix: ``shard, position, row, doc_id, source, pass, first_word, n_words``,
    one per block drawn, in the order of its shard.
    """
    spark = docs.sparkSession
    rows = document_rows(docs)
    sources = source_targets(rows, weights, share, most)
    rows = _with_sources(rows, sources)
    drawn = staged(_permuted(rows, seed), "mixing/drawn")
    counts = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("k"))
    quotas = {r.sid: r.k for r in counts.orderBy("sid").collect()}  # a row a source
    shards = max(1, -(-sum(quotas.values()) // SHARD_BLOCKS))
    tree = spark.range(0, shards, 1, min(shards, shuffle_count(spark))).mapInArrow(
        lambda it: _leaf_batches(it, quotas, shards, seed), "shard long, sid long, first_rank long, n long"
    )
    # runs meet ranks by steps of about a run's length, so a step meets few runs
    step = F.greatest(F.floor(F.col("k") / shards), F.lit(1))
    step = counts.select("sid", step.alias("step"))
    step = F.broadcast(step) if len(quotas) <= BROADCAST_SOURCES else step
    runs = tree.join(step, "sid")
    cells = F.sequence(
        F.floor(F.col("first_rank") / F.col("step")), F.floor((F.col("first_rank") + F.col("n") - 1) / F.col("step"))
    )
    runs = runs.select("sid", "shard", "first_rank", "n", F.explode(cells).alias("cell"))
    drawn = drawn.join(step, "sid").withColumn("cell", F.floor(F.col("rank") / F.col("step")))
    mix = drawn.join(runs, ["sid", "cell"]).where("first_rank <= rank AND rank < first_rank + n")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "h"), "h", "doc_id", "first_word", "row")
    mix = mix.withColumn("position", F.row_number().over(local) - 1)  # a shard is SHARD_BLOCKS rows
    kept = ["shard", "position", "row", "doc_id", "source", "pass", "first_word", "n_words"]
    return rows.select("row", "doc_id", "source", "size", "source_size", "target"), mix.select(*kept)


def mixed_texts(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """``mix`` with each block's ``text``, its words joined by spaces, sorted by
    shard and position.  ``docs`` needs one row per doc_id."""
    words = docs.select("doc_id", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    # a document's words are cut where its draws meet them, so no text is repeated in the shuffle
    draws = mix.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "position", "source", "pass", "first_word", "n_words")).alias("d"))
    cut = words.join(draws, "doc_id").select("doc_id", "words", F.explode("d").alias("d"))
    text = F.array_join(F.slice("words", F.col("d.first_word").cast("int") + 1, F.col("d.n_words").cast("int")), " ")
    out = cut.select("d.*", "doc_id", text.alias("text"))
    return out.repartition(shuffle_count(docs.sparkSession), "shard").sortWithinPartitions("shard", "position")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, mix = mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = mix.groupBy("row").agg(F.sum("n_words").alias("taken"))
    out = rows.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
