"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint.  Lower-case A-Z, words between ASCII white space, shingles of
``shingle`` words (a shorter text is one shingle), XXH64 with seed 42 of
each; a bit is set if it is set in over half the hashes.  No word:
fingerprint zero.

Candidates.  A fingerprint is cut in segments A and B of 23 bits and C of 18
bits.  The perfect binary Golay code [23,12,7] decodes any 23-bit word to
one codeword.  The fuzzy keys of a word are the codewords of the word and of
its 23 one-bit changes: one or six.  Words at most 2 bits apart share a key,
as a word halfway between is within one bit of both.  By pigeonhole, up to
``MAX_BITS`` = 3 errors, spread as (a, b, c), always meet in a table:

    b = 0, a <= 2    key(A), B exact                            (35 bits)
    a = 0, b <= 2    A exact, key(B)                            (35 bits)
    c = 0, a <= 2    key(A), C exact, with any b                (30 bits)
    a = 3            B and C exact                              (41 bits)
    a = b = c = 1    a half of each segment exact, in 8 ways (31-33 bits)

(Two errors in one segment leave one, so another segment is exact.)
Candidates are then compared bit by bit.

Groups.  Only distinct fingerprints are hashed, so exact copies cost one
row.  Buckets that have the same members (by count, smallest, and XORs) are
looked at once.  Within a bucket no pairs are emitted: a breadth-first search
over the members emits a spanning forest of the links, which keeps every
connection.  A bucket of over ``CHUNK`` fingerprints is
dealt out as pairs of chunks, so no task holds more than two chunks.
Components come from repeated contraction of the edges to neighbours of
least random priority; nothing is collected.

Cases.  Null text: as empty.  Null doc_id: linked like any other; it never
names a component unless all its ids are null (then null).  Equal doc_ids
and repeated rows each get their row.  An empty table gives an empty table.
Other columns are ignored, and passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import named_back, neutral, read_table, record_batch, staged

SHINGLE = 3
SEED = 42
MAX_BITS = 3
CHUNK = 4096
#: Generator polynomial of the binary Golay code (fixed value):
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GOLAY = 0b110001110101


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return digest(joined, SEED)
    after = list(accumulate(len(w) + 1 for w in words))
    first, last = [0, *after], after[shingle - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65_536):
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(first[lo : lo + 65_536], last[lo : lo + 65_536])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, *, text: str = "text", keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Columns of ``keep`` and ``_fp``, the fingerprint as a signed long."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_fp_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(keep)
            fps = np.array([fingerprint(t, shingle) for t in batch.column(n).to_pylist()], dtype="<u8").view("<i8")
            schema = pa.schema([batch.schema.field(i) for i in range(n)] + [("_fp", pa.int64())])
            yield record_batch(schema, [*[batch.column(i) for i in range(n)], fps])

    return picked.mapInArrow(run, f"{fields}, _fp long")


class Golay:
    """Syndrome decoding of 23-bit words to 12-bit codeword numbers."""

    def __init__(self):
        one = [self._remainder(1 << i) for i in range(23)]
        error = np.zeros(2048, dtype=np.int64)
        for weight in (1, 2, 3):  # 1 + 23 + 253 + 1771 patterns: one for each syndrome
            for bits in combinations(range(23), weight):
                syndrome = 0
                for b in bits:
                    syndrome ^= one[b]
                error[syndrome] = sum(1 << b for b in bits)
        self.error = error
        self.tables = []
        for shift in (0, 8, 16):
            table = np.zeros(256, dtype=np.int64)
            for byte in range(256):
                for b in range(8):
                    if byte >> b & 1 and shift + b < 23:
                        table[byte] ^= one[shift + b]
            self.tables.append(table)

    @staticmethod
    def _remainder(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GOLAY << (i - 11)
        return word

    def decode(self, words: np.ndarray) -> np.ndarray:
        """Number of the nearest codeword (its 12 high bits)."""
        t0, t1, t2 = self.tables
        syndrome = t0[words & 255] ^ t1[words >> 8 & 255] ^ t2[words >> 16]
        return (words ^ self.error[syndrome]) >> 11

    def fuzzy_keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key): the distinct codewords within one bit change of each word."""
        changes = np.array([0, *(1 << b for b in range(23))], dtype=np.int64)
        near = np.sort(self.decode(words[:, None] ^ changes[None, :]), axis=1)
        new = np.ones(near.shape, dtype=bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, column = np.nonzero(new)
        return row, near[row, column]


_GOLAY: list[Golay] = []


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every table for unsigned fingerprints; the key's top
    byte names the table."""
    if not _GOLAY:
        _GOLAY.append(Golay())
    golay = _GOLAY[0]
    mask = np.uint64((1 << 23) - 1)
    a = (fps & mask).astype(np.int64)
    b = (fps >> np.uint64(23) & mask).astype(np.int64)
    c = (fps >> np.uint64(46)).astype(np.int64)
    every = np.arange(len(fps))
    row_a, key_a = golay.fuzzy_keys(a)
    row_b, key_b = golay.fuzzy_keys(b)
    parts = [
        (every, b << 18 | c, 0),
        (row_b, a[row_b] << 12 | key_b, 1),
        (row_a, b[row_a] << 12 | key_a, 2),
        (row_a, c[row_a] << 12 | key_a, 3),
    ]
    halves = [(x & (1 << low) - 1, x >> low) for x, low in ((a, 11), (b, 11), (c, 9))]
    for table, (i, j, k) in enumerate(product((0, 1), repeat=3), len(parts)):
        parts.append((every, halves[0][i] << 21 | halves[1][j] << 9 | halves[2][k], table))
    return np.concatenate([r for r, _, _ in parts]), np.concatenate([k | t << 56 for _, k, t in parts])


def bucket_entries(distinct: DataFrame) -> DataFrame:
    """(_key, _fp) of every table, for distinct fingerprints."""
    schema = pa.schema([("_key", pa.int64()), ("_fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fps), 2048):
                part = fps[lo : lo + 2048]
                row, key = bucket_keys(part.view("<u8"))
                yield record_batch(schema, [key, part[row]])

    return distinct.select("_fp").mapInArrow(run, "_key long, _fp long")


def spanning_links(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among ``fps``: each member is compared
    with those not yet reached, so a dense bucket costs few comparisons."""
    left, right, rest = [], [], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            near = np.bitwise_count(rest ^ u) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                left += [int(u)] * len(found)
                right += found.tolist()
    return left, right


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (_u, _v) whose components are those of all links between the
    distinct fingerprints ``_fp``."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the tables cover up to {MAX_BITS} differing bits")
    entries = bucket_entries(distinct)
    buckets = (
        entries.groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_m"), F.min("_fp").alias("_lo"), F.bit_xor("_fp").alias("_xor"), F.bit_xor(F.xxhash64("_fp")).alias("_x"))
        .where("_m > 1")
        .groupBy("_m", "_lo", "_xor", "_x")  # buckets of the same members: once
        .agg(F.min("_key").alias("_key"))
    )
    buckets = staged(buckets, "simhash/buckets")
    pairs = buckets.where("_m = 2").where(F.bit_count("_xor") <= max_bits)
    pairs = pairs.select(F.col("_lo").alias("_u"), F.col("_lo").bitwiseXOR(F.col("_xor")).alias("_v"))

    chunks = F.ceil(F.col("_m") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("_fp", F.lit("chunk")), F.col("_s")).cast("int")
    members = (
        entries.join(buckets.where("_m > 2").select("_key", chunks.alias("_s")), "_key")
        .withColumn("_c", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)))
        .select("_key", F.least("_c", "_other").alias("_i"), F.greatest("_c", "_other").alias("_j"), "_fp")
        .repartition("_key", "_i", "_j")
        .sortWithinPartitions("_key", "_i", "_j", "_fp")
    )
    schema = pa.schema([("_u", pa.int64()), ("_v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []  # a run of equal (key, i, j) may span batches

        def flush() -> pa.RecordBatch:
            return record_batch(schema, list(spanning_links(np.concatenate(held), max_bits)))

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            us, vs = [], []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if group != tuple(keys[a]):
                    if held:
                        u, v = spanning_links(np.concatenate(held), max_bits)
                        us += u
                        vs += v
                    group, held = tuple(keys[a]), []
                held.append(fps[a:b])
            yield record_batch(schema, [us, vs])
        if held:
            yield flush()

    return pairs.union(members.mapInArrow(run, "_u long, _v long")).distinct()


def contract(edges: DataFrame) -> DataFrame | None:
    """Components of ``edges`` (_u, _v): (_fp, _label) of every end, equal
    labels for connected ends.  None if there is no edge.

    Each round every node points to its neighbour (or itself) of least
    random priority, and edges are redrawn between the nodes pointed to; with
    random priorities a path shrinks by a constant factor a round.
    """
    edges, labels, round_ = staged(edges, "simhash/edges"), None, 0
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        step = both.groupBy("_u").agg(F.min(rank("_v")).alias("_best"))
        step = staged(step.select("_u", F.least("_best", rank("_u"))["n"].alias("_to")), f"simhash/step{round_}")
        to_u, to_v = step, step.select(F.col("_u").alias("_v"), F.col("_to").alias("_to_v"))
        edges = (
            edges.join(to_u, "_u")
            .join(to_v, "_v")
            .select(F.least("_to", "_to_v").alias("_u"), F.greatest("_to", "_to_v").alias("_v"))
            .where("_u <> _v")
            .distinct()
        )
        edges = staged(edges, f"simhash/edges{round_}")
        if labels is None:
            labels = step.select(F.col("_u").alias("_fp"), F.col("_to").alias("_label"))
        else:
            moved = step.select(F.col("_u").alias("_label"), F.col("_to").alias("_next"))
            labels = labels.join(moved, "_label", "left").select("_fp", F.coalesce("_next", "_label").alias("_label"))
        round_ += 1
    return None if labels is None else staged(labels, "simhash/labels")


def components(rows: DataFrame, pick, max_bits: int = MAX_BITS) -> DataFrame:
    """``rows`` has ``_fp``; the result has one row per distinct fingerprint:
    ``_fp`` and ``_pick``, the aggregate ``pick`` over all rows of its
    component (``pick(None)`` over rows, ``pick(column)`` over such picks)."""
    classes = staged(rows.groupBy("_fp").agg(pick(None).alias("_first")), "simhash/classes")
    labels = contract(links(classes, max_bits))
    if labels is None:
        return classes.select("_fp", F.col("_first").alias("_pick"))
    labelled = classes.join(labels, "_fp", "left").select("_fp", "_first", F.coalesce("_label", "_fp").alias("_label"))
    picks = labelled.groupBy("_label").agg(pick("_first").alias("_pick"))
    return labelled.join(picks, "_label").select("_fp", "_pick")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs``."""
    rows = staged(with_fingerprint(docs, keep=["doc_id"], shingle=shingle), "simhash/fingerprints")
    found = components(rows, lambda c: F.min(c or "doc_id"), max_bits)
    return rows.join(found, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_pick").alias("component_id")
    )


def keep_one(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the
    row of the smallest doc_id stays, one of them if several have it."""
    rows, names = neutral(docs)
    rows = rows.withColumn("_uid", F.monotonically_increasing_id())
    keep = [*names.values(), "_uid"]
    rows = staged(with_fingerprint(rows, text=names["text"], keep=keep, shingle=shingle), "simhash/rows")
    ids = rows.select(F.col(names["doc_id"]).alias("doc_id"), "_uid", "_fp")
    first = lambda c: F.min(c or F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_uid"))
    kept = components(ids, first, max_bits).select(F.col("_pick._uid").alias("_uid")).distinct()
    return named_back(rows.join(kept, "_uid", "left_semi"), names)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
