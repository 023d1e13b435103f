"""Spelling variants: words one edit apart, and the frequent form behind each.

Method: k-d trees over letter-count vectors.  One edit moves a word's vector
by an L1 distance of at most two: a replaced letter takes one away and adds
one, an inserted letter adds one.  So the near words of a word lie in a small
box around its vector, once among the words of its own length and once among
those one letter longer (the pair is then found from its shorter word).

1. *Upper trees* (one per word length) cut the words into cells.  They are
   fitted on a sample of at most about ``SAMPLE_WORDS`` words, drawn by hash;
   every word is placed.  As data a word goes to one cell, as a query to each
   cell that its box meets: at most one letter gained and one lost on the
   way down.  Cells of more than ``CHUNK_WORDS`` words (words of equal
   letters cannot be cut) are dealt in chunks that each meet all queries.
2. *Lower trees*: a task builds a cell's tree from its words and runs the
   queries through it in Arrow batches.  Every node keeps the tight bounds of
   its words in every letter; queries beyond them are pruned.
3. What is left at a leaf is verified letter by letter, in order.

A task holds one chunk and one batch of queries at a time.  The links are
pre-aggregated to count and best near word; roots follow forms by pointer
doubling, as counts grow tenfold with each step (at most five rounds).

Defined cases: null or empty words and words of n null take no part; a word
given twice counts with its sum; no words give an empty result; ties of n go
to the smaller word in code-point order; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import read_table, shuffle_count, staged

SAMPLE_WORDS = 65_536
CELL_WORDS = 4_096
CHUNK_WORDS = 16_384
LEAF_WORDS = 16
#: A cell of the upper tree has this many words of the sample at least.
LEAST_SAMPLE = 16
#: Letters are counted by code point modulo this; a fold can only bring vectors nearer.
CLASSES = 256

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Counts per class, a column per word (so that sums over classes run along rows)."""
    m, length = codes.shape
    cells = np.arange(m)[None, :] + (codes.T % CLASSES).astype(np.int64) * m
    counts = np.bincount(cells.ravel(), minlength=m * CLASSES).reshape(CLASSES, m)
    return counts.astype(np.uint8 if length < 256 else np.int32)


def _best_split(counts: np.ndarray, rows: np.ndarray) -> tuple[int, int] | None:
    """(class, threshold) of the most even cut into <= and >."""
    c = counts[:, rows]
    best, found = 0, None
    for k in np.flatnonzero(c.max(1) > c.min(1)):
        sizes = np.cumsum(np.bincount(c[k]))[:-1]
        even = np.minimum(sizes, len(rows) - sizes)
        t = int(even.argmax())
        if even[t] > best:
            best, found = int(even[t]), (int(k), t)
    return found


class UpperTree:
    """Cells of one word length: inner nodes (class, threshold, left, right), leaves -(cell + 1)."""

    def __init__(self, words: list[str], length: int, cells: int):
        self.nodes: list[tuple[int, int, int, int]] = []
        self.cells = 0
        counts = letter_counts(letters(words, length)) if words else None
        least = max(LEAST_SAMPLE, -(-len(words) // max(cells, 1)))
        self.root = self._grow(counts, np.arange(len(words)), least)

    def _grow(self, counts, rows, least) -> int:
        split = _best_split(counts, rows) if len(rows) >= 2 * least else None
        if split is None:
            self.cells += 1
            return -self.cells
        at = len(self.nodes)
        self.nodes.append((0, 0, 0, 0))
        low = counts[split[0], rows] <= split[1]
        self.nodes[at] = (*split, self._grow(counts, rows[low], least), self._grow(counts, rows[~low], least))
        return at

    def route(self, counts: np.ndarray, gain: int, lose: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, cell) pairs: the cells that hold vectors at most ``gain``
        letters more and ``lose`` letters fewer away."""
        m = counts.shape[1]
        words, cells = [], []
        todo = [(self.root, np.arange(m), np.full(m, gain, np.int8), np.full(m, lose, np.int8))]
        while todo:
            node, rows, gains, losses = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                words.append(rows)
                cells.append(np.full(len(rows), -node - 1))
                continue
            k, t, left, right = self.nodes[node]
            c = counts[k, rows].astype(np.int32)
            need = np.clip(c - t, 0, 2)  # letters to lose for the left side
            to = need <= losses
            todo.append((left, rows[to], gains[to], (losses - need)[to]))
            need = np.clip(t + 1 - c, 0, 2)
            to = need <= gains
            todo.append((right, rows[to], (gains - need)[to], losses[to]))
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(words), np.concatenate(cells)


def _ones(masks: np.ndarray) -> np.ndarray:
    """Set bits over the 64-bit words of the first axis, 255 standing for more."""
    n = np.bitwise_count(masks[0])
    for more in masks[1:]:
        n = np.minimum(n, 255 - 64) + np.bitwise_count(more)
    return n


class LowerTree:
    """The words of one cell, with tight bounds at every node.

    Counts are unary: a class that occurs up to c times in a word here has c
    bits, the first of them set as often as it occurs.  So AND and OR over words
    are the lower and upper bounds of a box, and the bits that one side has
    alone are the letters to lose or to gain.
    """

    def __init__(self, words: list[str], length: int):
        self.length, self.words = length, np.array(words, dtype=object)
        self.codes = letters(words, length)
        counts = letter_counts(self.codes)
        most = counts.max(1).astype(np.int64)
        self.levels = [(k, level) for k in np.flatnonzero(most).tolist() for level in range(most[k])]
        self.bits = np.stack([counts[k] > level for k, level in self.levels])
        self.masks = self._packed(self.bits)
        self.nodes: list = []  # (lowest, highest, left, right) or (lowest, highest, rows)
        self._grow(np.arange(len(words)))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        """A column of 64-bit words for each column of bits."""
        out = np.zeros((-(-len(bits) // 64), bits.shape[1]), np.uint64)
        for i, bit in enumerate(bits):
            out[i // 64] |= bit.astype(np.uint64) << np.uint64(i % 64)
        return out

    def _grow(self, rows: np.ndarray) -> int:
        at, mine = len(self.nodes), self.masks[:, rows]
        self.nodes.append(None)
        low, high = np.bitwise_and.reduce(mine, 1)[:, None], np.bitwise_or.reduce(mine, 1)[:, None]
        split = None
        if len(rows) > LEAF_WORDS:
            bits = self.bits[:, rows]
            ones = bits.sum(1)
            even = np.minimum(ones, len(rows) - ones)
            split = bits[even.argmax()] if even.max() else None
        if split is None:
            self.nodes[at] = (low, high, rows)
        else:
            self.nodes[at] = (low, high, self._grow(rows[~split]), self._grow(rows[split]))
        return at

    def near(self, queries: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) index pairs exactly one edit apart; ``length`` is that
        of the queries, the words' own or one less."""
        codes = letters(queries, length)
        counts = letter_counts(codes)
        bits = np.stack([counts[k] > level for k, level in self.levels])
        # letters of a query that no word here has must all be lost
        extra = np.minimum(length - bits.sum(0), 2)
        asked = self._packed(bits)
        gain, lose = 1, np.int8(1 if length == self.length else 0)
        found_q, found_w = [], []
        extra = extra.astype(np.int8)
        todo = [(0, np.flatnonzero(extra <= lose))]
        while todo:
            node, rows = todo.pop()
            low, high, *rest = self.nodes[node]
            q = asked[:, rows]
            near = (_ones(low & ~q) <= gain) & (_ones(q & ~high) <= lose - extra[rows])
            rows = rows[near]
            if not len(rows):
                continue
            if len(rest) == 2:
                todo += [(rest[0], rows), (rest[1], rows)]
                continue
            for part in range(0, len(rest[0]), LEAF_WORDS):  # words of equal letters make large leaves
                some = rest[0][part : part + LEAF_WORDS]
                q, w = asked[:, None, rows], self.masks[:, some, None]
                wi, qi = np.nonzero((_ones(w & ~q) <= gain) & (_ones(q & ~w) <= lose - extra[rows]))
                if len(qi):
                    found_q.append(rows[qi])
                    found_w.append(some[wi])
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        qs, ws = np.concatenate(found_q), np.concatenate(found_w)
        one = self._one_edit(codes[qs], self.codes[ws])
        return qs[one], ws[one]

    def _one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if a.shape[1] == b.shape[1]:
            return (a != b).sum(1) == 1
        # b is a with one letter inserted: some cut has all letters equal
        # before it, and all after it equal to the next one of b
        n = a.shape[1]
        ahead, behind = a != b[:, :n], a != b[:, 1:]
        first = np.where(ahead.any(1), ahead.argmax(1), n)
        last = np.where(behind.any(1), n - 1 - behind[:, ::-1].argmax(1), -1)
        return last < first


#: role of a routed row: a word of the cell, a query of its length, a query one letter shorter
DATA, SAME, SHORTER = 0, 1, 2
ROUTED = "word string, n long, length int, cell int, role int"
LINKS = "word string, near string, near_n long"


def _routes(batches: Iterator[pa.RecordBatch], trees: dict[int, UpperTree]) -> Iterator[pa.RecordBatch]:
    one = UpperTree([], 0, 1)  # a length that the sample lacks is one cell
    for batch in batches:
        words, ns = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            some = [words[i] for i in rows]
            counts = letter_counts(letters(some, length))
            ways = [(DATA, length, 0, 0), (SAME, length, 1, 1), (SHORTER, length + 1, 1, 0)]
            for role, to, gain, lose in ways:
                at, cells = trees.get(to, one).route(counts, gain, lose)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some).take(pa.array(at)),
                        pa.array(ns[rows[at]], pa.int64()),
                        pa.array(np.full(len(at), to, np.int32)),
                        pa.array(cells.astype(np.int32)),
                        pa.array(np.full(len(at), role, np.int32)),
                    ],
                    names=["word", "n", "length", "cell", "role"],
                )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, then role: the words of a cell come before its queries."""
    key, words, ns, tree = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(i).to_numpy() for i in (2, 3, 4, 5)])  # length, cell, chunk, role
        cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            here, role = tuple(place[:3, lo].tolist()), int(place[3, lo])
            if here != key:
                key, words, ns, tree = here, [], [], None
            some, some_n = batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_numpy()
            if role == DATA:
                words += some
                ns.append(some_n)
                continue
            if not words:
                continue  # queries only: no word of that length in the cell
            if tree is None:
                tree, tree_n = LowerTree(words, here[0]), np.concatenate(ns)
            qs, ws = tree.near(some, here[0] - (role == SHORTER))
            if not len(qs):
                continue
            a, b = np.array(some, dtype=object)[qs], tree.words[ws]
            an, bn = some_n[qs], tree_n[ws]
            if role == SHORTER:  # the longer word does not ask
                a, b, bn = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([bn, an])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(bn, pa.int64())],
                names=["word", "near", "near_n"],
            )


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every ordered pair of words one edit apart.
    ``words``: distinct ``word`` (not empty) and its ``n``."""
    spark = words.sparkSession
    total = words.count()
    share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_WORDS / max(total, 1)))
    sample: dict[int, list[str]] = {}
    for r in words.where(share).select("word").collect():  # about SAMPLE_WORDS at most
        sample.setdefault(len(r[0]), []).append(r[0])
    grow = max(total / SAMPLE_WORDS, 1.0)
    trees = {n: UpperTree(sorted(s), n, int(len(s) * grow / CELL_WORDS) + 1) for n, s in sample.items()}
    routed = words.select("word", "n").mapInArrow(lambda it: _routes(it, trees), ROUTED)
    # two scans of the words, rather than the routed rows written
    sizes = routed.where(F.col("role") == DATA).groupBy("length", "cell").agg(F.count(F.lit(1)).alias("m"))
    large = staged(sizes.where(F.col("m") > CHUNK_WORDS), "spelling/large")
    chunks = F.ceil(F.coalesce(F.col("m"), F.lit(1)) / CHUNK_WORDS).cast("int")
    mine = F.pmod(F.xxhash64("word"), chunks).cast("int")
    # cells are bounded by the sample's size and the number of lengths
    dealt = routed.join(F.broadcast(large), ["length", "cell"], "left").withColumn(
        "chunk", F.explode(F.when(F.col("role") == DATA, F.array(mine)).otherwise(F.sequence(F.lit(0), chunks - 1)))
    )
    rows = dealt.select("word", "n", "length", "cell", "chunk", "role")
    rows = rows.repartition(shuffle_count(spark), "length", "cell", "chunk")
    return rows.sortWithinPartitions("length", "cell", "chunk", "role").mapInArrow(_search, LINKS)


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word.

    ``form``: the near word of largest n, if that is ``ratio`` (2 or more)
    times the word's own at least; ``root``: the end of the chain of forms.
    """
    words = words.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = staged(words, "spelling/words")
    # rows of a word are as many as its near words, so no group is hot
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    large = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.near")).alias("form"),
        F.when(large, -F.col("best.minus")).alias("form_n"),
    )
    forms = staged(forms, "spelling/forms")
    roots = _roots(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = forms.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(up: DataFrame) -> DataFrame:
    """``word, root`` by pointer doubling; a word has few variants, so no hub is hot."""
    up = staged(up, "spelling/roots")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = up.join(above, "root", "left")
        up = staged(step.select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling/roots")
        if up.where("next IS NOT NULL").isEmpty():
            return up.select("word", "root")
        up = up.select("word", "root")


def run_words(text: Column, least: int) -> Column:
    """Maximal runs of Latin letters with ``least`` code points or more, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({RUN}{{{least},}})"), F.lit(1))


def noisy_words(docs: DataFrame, least: int = 7, least_n: int = 2, noise: int = 31) -> DataFrame:
    """``word, n``: the runs of all documents, where a run whose crc32 with its
    document's id is divisible by ``noise`` has lost one letter.  A null id
    stands as empty text.  Shorter runs cannot give a word, so they are not cut out."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(key.alias("key"), F.explode(run_words(F.col("text"), least)).alias("run"))
    h = F.crc32(F.concat(F.col("key"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod(F.col("h"), F.lit(noise)) == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(noisy_words(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
