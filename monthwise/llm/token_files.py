"""Token-id files: documents encoded with a public tokenizer, written as
Simple-8b blocks in ascending doc_id order, and read back.

Layout.  ``<root>/blocks`` is a Parquet table with one row per block: the
``part`` (global order of the blocks is part, then ``first``), ``first``
(ids of the part before the block), the documents' ids and token counts, the
Simple-8b ``words`` (little-endian 64-bit), and ``word_start``, the word
offset of every 1,024 ids for decoding from the middle.  A block holds whole
documents and about ``block_ids`` ids; a longer document is a block of its
own.  The container is Spark's writer, so files appear by commit and a lost
executor costs a repeated task.  ``<root>/parts`` has the id count of each
part, a row a part; a document's global start is the sum over the parts
before it, plus its place in its part.

Order and plan.  Texts are range-partitioned by (doc_id, text hash) and
sorted, once; encoding happens after that shuffle, so ids are never
shuffled.

Cases.  Null text: empty, so the end id alone.  Null doc_id: first in order.
Equal doc_ids and repeated rows: ordered by text hash, each has its own
entry.  An empty table gives empty tables.  Special tokens written out in a
text become their ids, as the library does.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm import simple8b
from monthwise.llm.bpe import PROVEN, SPACE, byte_alphabet
from monthwise.llm.common import read_table, shuffle_count
from monthwise.session import scratch_path

BLOCK_IDS = 65_536
TABLE_LIMIT = 800_000

BLOCKS = "part int, first long, doc_ids array<long>, n_tokens array<long>, words binary, word_start array<long>"


class Words(dict):
    """Ids by word; a word not in the table is encoded by ``encode``, which
    may add it."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> bytes:
        return self._encode(word)


class WordEncoder:
    """``Tokenizer.encode(text, add_special_tokens=False).ids`` of a
    word-end BPE file, with a table of words already encoded.

    No token spans a space, so a text is the concatenation of its
    space-separated words: an unseen word is normalised and cut by the
    file's own pre-token pattern, and each new piece is encoded by the
    library's model.  A word with a character outside ``PROVEN`` (whose class
    or composition may depend on the Unicode version) is given to the library
    whole.
    """

    def __init__(self, path: str, table_limit: int = TABLE_LIMIT):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._library, self._model = tokenizer, tokenizer.model
        self._unproven = re.compile(f"[^{PROVEN}]")
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self._special_ids = special
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        pattern = json.loads(tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(pattern.replace(r"\s", SPACE))
        self._alphabet = byte_alphabet()
        self._words = Words(self._word)
        self.table_limit = table_limit

    def _piece(self, piece: str) -> bytes:
        """Ids of a normalised piece.  An ASCII piece gives the same as a word,
        so one table serves both; others may compose anew if they were words
        (j and a caron, of J and a caron), so their key has a line feed, which
        no word holds."""
        key = piece if piece.isascii() else "\n" + piece
        got = self._words.get(key)
        if got is None:
            mapped = piece if piece.isascii() and piece.isprintable() else "".join([self._alphabet[b] for b in piece.encode()])
            got = array("I", [t.id for t in self._model.tokenize(mapped)]).tobytes()
            self._keep(key, got)
        return got

    def _keep(self, word: str, ids: bytes) -> None:
        if len(self._words) >= self.table_limit:
            self._words.clear()
        if len(word) <= 64:
            self._words[word] = ids

    def _word(self, word: str) -> bytes:
        if not word.isascii() and self._unproven.search(word):
            got = array("I", self._library.encode(word, add_special_tokens=False).ids).tobytes()
            self._keep(word, got)
            return got
        plain = word if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ")
        plain = plain.lower()
        letters = plain.rstrip(punctuation)
        if letters.isalpha():  # the pattern's letters, as all are proven
            got = self._piece(letters)
            if len(letters) < len(plain):
                got += self._piece(plain[len(letters) :])
        else:
            got = b"".join([self._piece(p) for p in self._pieces.findall(plain)])
        self._keep(word, got)
        return got

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text and not self._special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [self._plain(text[at : m.start()]), self._special_ids[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _block(part: int, first: int, ids: list, counts: list[int], chunks: list[bytes]) -> dict:
    values = np.frombuffer(b"".join(chunks), "<u4")
    words, word_start = simple8b.encode(values)
    return {
        "part": part,
        "first": first,
        "doc_ids": ids,
        "n_tokens": counts,
        "words": words.astype("<u8").tobytes(),
        "word_start": word_start,
    }


def write_token_files(
    docs: DataFrame, root: str, path: str, end_id: int, *, block_ids: int = BLOCK_IDS, parts: int | None = None
) -> None:
    """Encode the whole texts of ``docs`` (doc_id, text) and write them under ``root``."""
    spark = docs.sparkSession
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("first", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("n_tokens", pa.list_(pa.int64())),
            ("words", pa.binary()),
            ("word_start", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = word_encoder(path), end_id.to_bytes(4, "little")
        part, first, size, ids, counts, chunks = 0, 0, 0, [], [], []
        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text in zip(doc_ids, texts):
                raw = enc.encode(text) + end
                ids.append(doc_id)
                counts.append(len(raw) // 4)
                chunks.append(raw)
                size += len(raw) // 4
                if size >= block_ids:
                    yield pa.RecordBatch.from_pylist([_block(part, first, ids, counts, chunks)], schema=schema)
                    first, size, ids, counts, chunks = first + size, 0, [], [], []
        if ids:
            yield pa.RecordBatch.from_pylist([_block(part, first, ids, counts, chunks)], schema=schema)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("_th", F.xxhash64("text"))
        .repartitionByRange(parts or shuffle_count(spark), "doc_id", "_th")
        .sortWithinPartitions("doc_id", "_th")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "uncompressed").parquet(f"{root}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    total = F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)")
    blocks.groupBy("part").agg(F.sum(total).alias("n_ids")).coalesce(1).write.parquet(f"{root}/parts")


def read_token_files(spark: SparkSession, root: str, *, digests: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens and ``ids`` (or, with
    ``digests``, ``ids_crc32`` of the ids as 32-bit integers)."""
    parts = spark.read.schema("part int, n_ids long").parquet(f"{root}/parts")
    # one row a part, so this window is as small as the number of files
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    placed = blocks.join(parts.select("part", before.cast("long").alias("offset")), "part").select(
        (F.col("offset") + F.col("first")).alias("at"), "doc_ids", "n_tokens", "words", "word_start"
    )
    last = "ids_crc32 long" if digests else "ids array<int>"
    kind = pa.int64() if digests else pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (last.split()[0], kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = batch.column(0)[row].as_py()
                counts = np.array(batch.column(2)[row].as_py(), dtype=np.int64)
                words = np.frombuffer(batch.column(3)[row].as_py(), "<u8")
                word_start = np.array(batch.column(4)[row].as_py(), dtype=np.int64)
                ids = simple8b.decode(words, word_start, int(counts.sum())).astype("<u4")
                ends = np.cumsum(counts)
                cut = [ids[b - c : b] for b, c in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[row].values,
                        pa.array(at + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(c.tobytes()) for c in cut] if digests else [c.astype(np.int32) for c in cut], kind),
                    ],
                    schema=schema,
                )

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    root = scratch_path(spark, "llm/token_files")
    write_token_files(read_table(spark, sf_dir, "documents"), root, word_bpe_path(), 1)
    return read_token_files(spark, root, digests=True)
