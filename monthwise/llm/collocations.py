"""Phrase collocations: counts of words and phrases from an FM-index per shard.

1. *Shards.*  Each task cuts its texts into pieces and words and writes shards
   of about ``SHARD_TOKENS`` words as arrays of local word ids, with a border
   between pieces, and each shard's vocabulary.  Words are told apart by
   language, so one shard holds any languages.
2. *Words.*  Counts are summed over shards.  Words of ``least`` occurrences or
   more keep an id, one for all shards; the others become borders, as no
   phrase with them can be frequent.
3. *Index.*  Per shard an FM-index over the word ids, sorted to the depth that
   the phrases need: the Burrows-Wheeler transform and the interval of every
   two-word phrase, which is the right extension of its first word's interval.
4. *Phrases.*  Two-word counts are interval sizes.  Three-word phrases are the
   left extensions of the two-word intervals: the transform's symbols inside
   an interval, counted.  An interval is extended only where both two-word
   phrases it would join can be frequent.  The frequent ones of all shards are
   told to the shards as a bit table of fixed size (``SLOTS`` bits), so what
   is broadcast does not grow; a wrong "can be" only costs a row, as counts
   are summed and checked after.
5. Counts of each length are summed over shards.  Scores are decimals of 38
   digits, divided as integers.

A task holds one shard.  Texts are cut at borders into steps of ``STEP_BYTES``,
so a long text is not held as words at once, unless it is one single piece.

Defined cases: null texts are empty; a null language is ``und``; languages
without a kept phrase have no row; ties are ranked by a, then phrase; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import read_table, shuffle_count, staged

SHARD_TOKENS = 3_000_000
STEP_BYTES = 1 << 20
SLOTS = 1 << 25
TOP_SALTS = 32

#: A byte that UTF-8 never has stands for the borders between pieces.
BORDER = b"\xff"
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_BORDER = bytes.maketrans(PIECE_ENDS, BORDER * len(PIECE_ENDS))

SHARDS = "shard long, id long, lang string, word string, n long, body binary"
INDEX = "shard long, symbols binary, firsts binary, seconds binary, sizes binary, bwt binary"
EMIT_ROWS = 50_000


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype)


def steps(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, borders between and after its pieces."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_TO_BORDER)  # bytes.lower: A-Z alone
    start = 0
    while start < len(data):
        end = data.find(BORDER, start + STEP_BYTES)
        end = len(data) if end < 0 else end
        words = data[start:end].replace(BORDER, b" \xff ").split()
        words.append(BORDER)
        yield words
        start = end


class _Shard:
    def __init__(self):
        ids = itertools.count(1)
        self.words = defaultdict(lambda: defaultdict(ids.__next__, {BORDER: 0}))
        self.parts, self.size = [np.zeros(1, np.int32)], 0

    def add(self, lang: str, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.words[lang].__getitem__, words), np.int32, len(words))
        self.parts.append(ids)
        self.size += len(ids)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        body = np.concatenate(self.parts)
        counts = np.bincount(body)
        yield _shard_rows([shard], [0], [None], [None], [0], [_pack(body)])
        for lang, words in self.words.items():
            words.pop(BORDER)
            names, ids = list(words), np.fromiter(words.values(), np.int64, len(words))
            for lo in range(0, len(names), EMIT_ROWS):
                some = ids[lo : lo + EMIT_ROWS]
                m = len(some)
                word = pa.array(names[lo : lo + EMIT_ROWS], pa.binary()).cast(pa.string())
                yield _shard_rows([shard] * m, some, [lang] * m, word, counts[some], [None] * m)


def _shard_rows(shard, ids, lang, word, n, body) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    columns = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip((shard, ids, lang, word, n, body), types)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "id", "lang", "word", "n", "body"])


def _write_shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) to shards; a shard's number is made of its task's and its own."""
    number = TaskContext.get().partitionId() << 20
    shard = _Shard()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for words in steps(text.as_py() or ""):
                shard.add(lang, words)
                if shard.size >= limit:
                    yield from shard.rows(number)
                    number, shard = number + 1, _Shard()
    if shard.size:
        yield from shard.rows(number)


class FmIndex:
    """Over ``text``, an array of symbols from 1 with borders 0, first place a
    border: the intervals of two-symbol phrases, in order, and the transform's
    symbols over them.  Rows within an interval are in text order."""

    def __init__(self, firsts: np.ndarray, seconds: np.ndarray, sizes: np.ndarray, bwt: np.ndarray):
        self.firsts, self.seconds, self.sizes, self.bwt = firsts, seconds, sizes, bwt

    @classmethod
    def of(cls, text: np.ndarray) -> FmIndex:
        at = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
        base = int(text.max(initial=0)) + 1
        key = text[at].astype(np.int64) * base + text[at + 1]
        order = np.argsort(key, kind="stable")
        key, bwt = key[order], text[at[order] - 1]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(np.append(starts, len(key))).astype(np.int32)
        pairs = key[starts]
        return cls((pairs // base).astype(np.int32), (pairs % base).astype(np.int32), sizes, bwt)

    def extend_left(self, symbols: np.ndarray, can_be) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, second, third, count) of the three-symbol phrases whose two
        halves pass ``can_be`` (two arrays of word ids to booleans)."""
        good = can_be(symbols[self.firsts], symbols[self.seconds])
        interval = np.repeat(np.arange(len(self.sizes)), self.sizes)
        rows = np.flatnonzero(good[interval] & (self.bwt > 0))
        before, interval = self.bwt[rows], interval[rows]
        joins = can_be(symbols[before], symbols[self.firsts[interval]])
        before, interval = before[joins].astype(np.int64), interval[joins]
        key, count = np.unique(interval * len(symbols) + before, return_counts=True)
        interval, before = key // len(symbols), key % len(symbols)
        return before, self.firsts[interval], self.seconds[interval], count


def _build_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, id): a shard's body, then (id, word id) of its frequent words."""

    def index(shard, body, ids, word_ids) -> pa.RecordBatch:
        text = _unpack(body, np.int32)
        ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        word_ids = np.concatenate(word_ids) if word_ids else np.empty(0, np.int64)
        # symbols in the order of word ids, so that what is summed over shards is sorted alike
        order = np.argsort(word_ids)
        symbol = np.zeros(int(text.max()) + 1, np.int32)
        symbol[ids[order]] = np.arange(1, len(ids) + 1)
        fm = FmIndex.of(symbol[text])
        parts = [np.concatenate([[-1], word_ids[order]]).astype(np.int64), fm.firsts, fm.seconds, fm.sizes, fm.bwt]
        columns = [pa.array([shard], pa.int64()), *[pa.array([_pack(p)], pa.binary()) for p in parts]]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "symbols", "firsts", "seconds", "sizes", "bwt"])

    shard, body, ids, word_ids = None, None, [], []
    for batch in batches:
        shards, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        words = batch.column(2).to_numpy()
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if lo == hi:
                continue
            if shards[lo] != shard:
                if body is not None:
                    yield index(shard, body, ids, word_ids)
                shard, body, ids, word_ids = int(shards[lo]), batch.column(3)[lo].as_py(), [], []
                lo += 1
            ids.append(places[lo:hi])
            word_ids.append(words[lo:hi])
    if body is not None:
        yield index(shard, body, ids, word_ids)


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, FmIndex]]:
    for batch in batches:
        for i in range(batch.num_rows):
            symbols, *parts = (batch.column(c)[i].as_py() for c in range(1, 6))
            yield _unpack(symbols, np.int64), FmIndex(*[_unpack(p, np.int32) for p in parts])


def _emitted(symbols: np.ndarray, phrase: list[np.ndarray], count: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [*[f"g{i + 1}" for i in range(len(phrase))], "n"]
    for lo in range(0, len(count), EMIT_ROWS):
        columns = [*[symbols[p[lo : lo + EMIT_ROWS]] for p in phrase], count[lo : lo + EMIT_ROWS].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for symbols, fm in _indexes(batches):
        yield from _emitted(symbols, [fm.firsts, fm.seconds], fm.sizes)


def _triples(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    bits = table.value

    def can_be(a, b):
        s = slots(a, b, 64 * len(bits))
        return (bits[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) > 0

    for symbols, fm in _indexes(batches):
        *phrase, count = fm.extend_left(symbols, can_be)
        yield from _emitted(symbols, phrase, count)


def slots(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """A bit of the table for each pair of word ids."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def _slot_masks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = np.unique(slots(batch.column(0).to_numpy(), batch.column(1).to_numpy(), size))
        mask = (np.uint64(1) << (s & 63).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(s >> 6, pa.int64()), pa.array(mask, pa.int64())], names=["at", "mask"])


def bit_table(pairs: DataFrame) -> np.ndarray:
    """The slots of all pairs: ``SLOTS / 64`` words, whatever the number of pairs."""
    size = SLOTS
    masks = pairs.select("g1", "g2").mapInArrow(lambda it: _slot_masks(it, size), "at long, mask long")
    found = masks.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found.column("at").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return bits


def _summed(counts: DataFrame, least: int, name: str) -> DataFrame:
    keys = [c for c in counts.columns if c != "n"]
    # a phrase has one row a shard, so summing before the shuffle would gain nothing
    dealt = counts.repartition(shuffle_count(counts.sparkSession), *keys)
    return staged(dealt.groupBy(*keys).agg(F.sum("n").alias("a")).where(F.col("a") >= least), name)


def phrase_counts(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sizes, words, pairs, triples) of the documents' ``lang`` and ``text``:
    ``lang, n``; ``g, lang, word, f``; ``g1, g2, a``; ``g1, g2, g3, a``, the
    last three with ``least`` occurrences or more."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    limit = SHARD_TOKENS
    shards = staged(texts.mapInArrow(lambda it: _write_shards(it, limit), SHARDS), "collocations/shards")
    words = shards.where("id > 0").select("shard", "id", "lang", "word", "n")
    sizes = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "collocations/sizes")
    # a word has one row a shard; the least of its places is its id
    place = F.col("shard") * (1 << 31) + F.col("id")
    every = Window.partitionBy("lang", "word")
    words = words.withColumn("g", F.min(place).over(every)).withColumn("f", F.sum("n").over(every))
    own = place == F.col("g")
    words = words.where(F.col("f") >= least).select(
        "shard", "id", "g", *[F.when(own, F.col(c)).alias(c) for c in ("lang", "word", "f")]
    )
    words = staged(words, "collocations/words")
    body = shards.where("id = 0").select("shard", "id", F.lit(None).cast("long").alias("g"), "body")
    rows = body.unionByName(words.select("shard", "id", "g"), allowMissingColumns=True).select("shard", "id", F.coalesce("g", F.lit(0)).alias("g"), "body")
    rows = rows.repartition(shuffle_count(spark), "shard").sortWithinPartitions("shard", "id")
    index = staged(rows.mapInArrow(_build_index, INDEX), "collocations/index")
    pairs = _summed(index.mapInArrow(_pairs, "g1 long, g2 long, n long"), least, "collocations/pairs")
    table = spark.sparkContext.broadcast(bit_table(pairs))
    triples = index.mapInArrow(lambda it: _triples(it, table), "g1 long, g2 long, g3 long, n long")
    triples = _summed(triples, least, "collocations/triples")
    return sizes, words.where("f IS NOT NULL").select("g", "lang", "word", "f"), pairs, triples


def _score(a: str, left: str, right: str) -> str:
    wide = "cast({} as decimal(18, 0))".format
    return f"({wide(a)} * {wide(a)} * 1000000BD) div ({wide(left)} * {wide(right)})"


def collocations(docs: DataFrame, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top``
    phrases of two or three words with ``least`` occurrences, scored by their
    weakest cut; those of which ``cover`` percent lie in one longer phrase are dropped."""
    sizes, words, pairs, triples = phrase_counts(docs, least)

    def word(i: int) -> DataFrame:
        return words.select(*[F.col(c).alias(f"{c}{i}") for c in ("g", "word", "f")], F.col("lang").alias(f"lang{i}"))

    ends = [triples.select("g1", "g2", "a"), triples.select(F.col("g2").alias("g1"), F.col("g3").alias("g2"), "a")]
    longer = ends[0].unionByName(ends[1]).groupBy("g1", "g2").agg(F.max("a").alias("longer"))
    two = pairs.join(longer, ["g1", "g2"], "left").where(f"longer IS NULL OR 100 * longer < {cover} * a")
    two = two.join(word(1), "g1").join(word(2).drop("lang2"), "g2")
    two = two.select(
        F.col("lang1").alias("lang"),
        F.concat_ws(" ", "word1", "word2").alias("phrase"),
        *["a", F.col("f1").alias("l"), F.col("f2").alias("r"), F.expr(_score("a", "f1", "f2")).alias("score")],
    )
    left = pairs.withColumnRenamed("a", "a12")
    right = pairs.select(F.col("g1").alias("g2"), F.col("g2").alias("g3"), F.col("a").alias("a23"))
    three = triples.join(left, ["g1", "g2"]).join(right, ["g2", "g3"])
    three = three.join(word(1), "g1").join(word(2).drop("lang2", "f2"), "g2").join(word(3).drop("lang3"), "g3")
    three = three.withColumn("s1", F.expr(_score("a", "f1", "a23"))).withColumn("s2", F.expr(_score("a", "a12", "f3")))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        F.col("lang1").alias("lang"),
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
        F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts of a language, so that a large one is not sorted in one task
    parts = Window.partitionBy("lang", "_part").orderBy(*order)
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))
    found = two.unionByName(three).withColumn("_part", part).withColumn("_at", F.row_number().over(parts))
    found = found.where(F.col("_at") <= top).drop("_part", "_at")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return found.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))
