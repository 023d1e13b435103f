"""Language identification by cross-parsing entropy.

Method.  For every language one suffix automaton is built over sample text
of that language.  A text is cross-parsed with each automaton: the longest
match with the sample from the current place is one phrase, the next phrase
starts after it.  Text of the sample's language needs few, long phrases.  A
phrase costs log2(sample length) bits (where in the sample it lies), so the
normalised count is phrases x log2(sample length); the language with the
smallest wins, and the score is its share under that code,
2^-bits / sum of 2^-bits.

Scoring runs over whole texts, in NumPy: automata are dense transition
tables, and texts are cut in segments of ``SEGMENT`` symbols that are parsed
side by side (a phrase ends at a cut, for every language alike).

The samples are bounded, which makes model and table sizes constants:
``pieces`` pieces of at most ``piece_chars`` characters per language, each
from a hash-chosen place of a document chosen by text hash among all
labelled rows, distinct texts only.  Everything else covers all rows.

Cases.  A null text, or one without a letter, is ``und`` with score 0.  Ties
go to the first language in alphabetical order.  Rows are independent, so
repeated rows get equal answers.  A null doc_id is not held out and not
learned from.  Without any labelled row, every text is ``und``.  Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import char_batches, fold, read_table, record_batch

PIECES = 96
PIECE_CHARS = 400
ALPHABET = 96
BUCKETS = 16
SEGMENT = 256
BATCH_CHARS = 2_000_000
UNDETERMINED = "und"


def symbol_table(texts: list[str]) -> tuple[np.ndarray, int]:
    """Code point -> symbol: 0 is padding, 1 any non-letter, then the most
    frequent letters (either case alike), then ``BUCKETS`` symbols that the
    other letters share by code-point block.  Also the number of symbols."""
    letters = Counter(c for t in texts for c in t.lower() if c.isalpha())
    common = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]]
    symbol = {c: i + 2 for i, c in enumerate(common)}
    table = np.ones(0x110000, dtype=np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = symbol.get(low if len(low) == 1 else c) or 2 + len(common) + (cp >> 7) % BUCKETS
    return table, 2 + len(common) + BUCKETS


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of ``text``; a run of non-letters is one symbol."""
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    if not len(s):
        return s
    keep = s != 1
    keep[1:] |= s[:-1] != 1
    keep[0] = True
    return s[keep]


def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton (state 0 is the start)."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in sequence:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in to[p]:
            to[p][s] = new
            p = link[p]
        if p >= 0:
            q = to[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(s) == q:
                    to[p][s] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return to


def parse_table(sequence: list[int], n_symbols: int) -> np.ndarray:
    """Dense table for cross-parsing: entry [state, symbol] is twice the next
    state's row offset, plus 1 if that symbol starts a phrase (no transition,
    so the parse goes on from the start state).  Padding starts none."""
    to = suffix_automaton(sequence)
    table = np.zeros((len(to), n_symbols), dtype=np.int32)
    for s, nxt in to[0].items():
        table[:, s] = nxt * n_symbols
    table = table * 2 + 1
    for state, row in enumerate(to):
        for s, nxt in row.items() if state else ():
            table[state, s] = nxt * n_symbols * 2
    table[:, 0] = 0
    return table.ravel()


class CrossParser:
    """Sample texts of each language -> phrases of any text per language."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.table, self.n_symbols = symbol_table([t for l in self.languages for t in samples[l]])
        self.tables, bits = [], []
        for language in self.languages:
            sequence = [s for t in samples[language] for s in [*symbols(t, self.table).tolist(), 1]]
            self.tables.append(parse_table(sequence, self.n_symbols))
            bits.append(np.log2(max(2, len(sequence))))
        self.bits = np.array(bits)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts, one row a text and one column a language."""
        parts = [symbols(t, self.table) for t in texts]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        lanes = -(-sizes // SEGMENT)
        first = np.cumsum(lanes) - lanes
        grid = np.zeros(int(lanes.sum()) * SEGMENT, dtype=np.uint8)
        for p, at in zip(parts, first * SEGMENT):
            grid[at : at + len(p)] = p
        grid = np.ascontiguousarray(grid.reshape(-1, SEGMENT).T)
        owner = np.repeat(np.arange(len(texts)), lanes)
        out = np.zeros((len(texts), len(self.languages)))
        for k, table in enumerate(self.tables):
            state = np.zeros(grid.shape[1], dtype=np.int32)
            count = np.zeros(grid.shape[1], dtype=np.int32)
            for row in grid:
                step = table.take(state + row)
                count += step & 1
                state = step >> 1
            out[:, k] = np.bincount(owner, weights=count, minlength=len(texts))
        return out

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winning language and its share, per text."""
        bits = self.phrases(texts) * self.bits
        best = bits.argmin(axis=1)
        share = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
        return best, 1 / share.sum(axis=1)


def sample_pieces(
    labelled: DataFrame, *, lang: str = "lang", text: str = "text", pieces: int = PIECES, piece_chars: int = PIECE_CHARS
) -> dict[str, list[str]]:
    """The bounded sample: ``pieces`` distinct documents per language (all, if
    it has fewer), chosen by text hash, and one piece of each.  One pass counts
    the distinct texts per language, one keeps the rows under the hash bound
    that follows; a language that it leaves short is drawn again, wider."""
    rows = labelled.select(F.col(lang).alias("_l"), F.col(text).alias("_t")).where("_l is not null and _t rlike '\\\\p{L}'")
    rows = rows.withColumn("_h", F.xxhash64("_t", F.lit("sample")))
    counts = {r["_l"]: r["n"] for r in rows.select("_l", "_h").distinct().groupBy("_l").agg(F.count(F.lit(1)).alias("n")).collect()}
    start = F.pmod(F.xxhash64("_t", F.lit("place")), F.greatest(F.lit(1), F.length("_t") - piece_chars + 1)) + 1
    out: dict[str, list[str]] = {}
    left, wide = counts, 2
    while left:
        bound = F.lit(-1)
        for language, n in left.items():
            bound = F.when(F.col("_l") == language, F.lit(int(min(1.0, wide * pieces / n) * (1 << 31)))).otherwise(bound)
        chosen = (
            rows.where(F.shiftrightunsigned("_h", 33) <= bound)
            .select("_l", "_h", F.expr("_t").substr(start.cast("int"), F.lit(piece_chars)).alias("_p"))
            .groupBy("_l", "_h")  # copies of one text count once
            .agg(F.min("_p").alias("_p"))
            .collect()
        )
        drawn: dict[str, list[str]] = {language: [] for language in left}
        for r in sorted(chosen, key=lambda r: (r["_l"], r["_h"])):
            drawn[r["_l"]].append(r["_p"])
        enough = {language: p[:pieces] for language, p in drawn.items() if len(p) >= min(pieces, left[language]) or wide * pieces >= left[language]}
        out |= enough
        left, wide = {language: n for language, n in left.items() if language not in enough}, wide * 4
    return {language: out[language] for language in counts if out[language]}


def identify(
    docs: DataFrame, samples: dict[str, list[str]], *, text: str = "text", keep: dict[str, Column] | None = None
) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row of ``docs``."""
    keep = keep or {"doc_id": F.col("doc_id")}
    picked = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_ok"))
    n = len(keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:n])
    model = CrossParser(samples) if samples else None
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a constant of the sample sizes, not of the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t if ok else "" for t, ok in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())]
            for lo, hi in char_batches(texts, BATCH_CHARS):
                lang, score = [UNDETERMINED] * (hi - lo), np.zeros(hi - lo)
                some = [i for i in range(lo, hi) if texts[i]]
                if some and model:
                    best, share = model.predict([texts[i] for i in some])
                    for i, b, s in zip(some, best, share):
                        lang[i - lo], score[i - lo] = model.languages[b], s
                schema = pa.schema([batch.schema.field(i) for i in range(n)] + [("lang_pred", pa.string()), ("score", pa.float64())])
                yield record_batch(schema, [*[batch.column(i).slice(lo, hi - lo) for i in range(n)], lang, score])

    return picked.mapInArrow(run, f"{fields}, lang_pred string, score double")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from fold mod 4 <> 2."""
    docs = read_table(spark, sf_dir, "documents")
    group = fold(F.col("doc_id"), 4)
    samples = sample_pieces(docs.where(group != 2))
    return identify(docs, samples, keep={"doc_id": F.col("doc_id"), "held_out": F.coalesce(group == 2, F.lit(False))})
