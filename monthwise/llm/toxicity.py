"""Toxicity by compression distance with two zstandard dictionaries.

Method.  One dictionary is trained on text of ordinary documents, a separate
one on toxic text.  A document's label says nothing of where its toxic
passage is, so the toxic training text is the words of toxic documents whose
document frequency stands out against ordinary documents (log-likelihood
ratio).  Scoring cuts the whole text into windows of ``WINDOW`` words and
compresses each window twice: with the ordinary dictionary, and with the
toxic one laid over the ordinary one (so that ordinary prose costs the same
in both).  The distance of a window is how many bytes shorter the second is.
The share and number of windows above several distances go into a logistic
function.  Its weights and threshold are calibrated on rows that the
dictionaries did not see: of two members, each has dictionaries of one half
of the sample and is calibrated on the other half, and a score is the mean
of both (as log-odds).

The training sample is bounded by ``POSITIVE`` and ``NEGATIVE`` labelled
rows (chosen by hash over all labelled rows) and ``PIECE_CHARS`` characters
from a hash-chosen place of each; every text is scored whole.

Cases.  A text without a distant window, such as a null or empty one, scores
below 0.5.  Without rows of both labels in both halves
every score is 0.  Conflicting labels of one doc_id count as toxic.  A null doc_id or label
is not learned from.  Rows are independent: repeated rows get equal scores.
Other columns are ignored or, in the pipeline, passed through.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import fold, forget_kept, named_back, neutral, read_table, record_batch, released, text_batches

POSITIVE = 1500
NEGATIVE = 3000
PIECE_CHARS = 8000
WINDOW = 4
WORD_BYTES = 48
LEVEL = 4
ORDINARY_BYTES = 65_536
TOXIC_BYTES = 2_048
MIN_RATIO = 25.0
MIN_LOG_ODDS = 2.0
MAX_DISTANCE = 12
MIN_DISTANCE = -3
#: Distances (bytes) whose windows are counted.
STEPS = (2, 3, 4, 6, 8)
BATCH_CHARS = 1_000_000

_WORD = re.compile(r"\w+")


def windows(blob: np.ndarray, doc_start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every window of ``width`` words of a blob
    of white-space separated documents that starts and ends with a space."""
    space = (blob == 32) | ((blob >= 9) & (blob <= 13))
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if not len(start):
        return start, end, start
    pieces = np.maximum(1, -(-(end - start) // WORD_BYTES))  # a very long word is several
    if pieces.max() > 1:
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, stop = np.repeat(start, pieces) + nth * WORD_BYTES, np.repeat(end, pieces)
        end = np.minimum(start + WORD_BYTES, stop)
    doc = np.searchsorted(doc_start, start, side="right") - 1
    first_word = np.searchsorted(doc, np.arange(len(doc_start)))
    nth = np.arange(len(start)) - first_word[doc]
    head = np.flatnonzero(nth % width == 0)
    last = np.append(head[1:], len(start)) - 1
    return start[head], end[last], doc[head]


def _train(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of ``samples``; where they are too few for the
    trainer, their most frequent ones themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        often = [s for s, _ in Counter(samples).most_common()]
        return b"".join(often)[:size] or b" "


class Dictionaries:
    """The ordinary dictionary, and the toxic one laid over it."""

    def __init__(self, texts: list[str], toxic: list[bool]):
        lowered = [t.lower() for t in texts]
        df = {True: Counter(), False: Counter()}
        for t, y in zip(lowered, toxic):
            df[y].update(set(_WORD.findall(t)))
        n1, n0 = sum(toxic), len(toxic) - sum(toxic)
        marked = {w for w in df[True] if _stands_out(df[True][w], df[False][w], n1, n0)}
        bad = [f" {w} ".encode() for t, y in zip(lowered, toxic) if y for w in _WORD.findall(t) if w in marked]
        ordinary = []
        for t, y in zip(lowered, toxic):
            if not y:
                words = t.split()
                ordinary += [f" {' '.join(words[i : i + 8])} ".encode() for i in range(0, len(words), 8)]
        order = random.Random(7)
        order.shuffle(bad)
        order.shuffle(ordinary)
        self.ordinary = _train(ordinary[:50_000], ORDINARY_BYTES) if ordinary else b" "
        self.toxic = _train(bad[:50_000], TOXIC_BYTES) if bad else b" "
        self._pair = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "_pair": None}

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        if self._pair is None:
            made = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                # as content alone: both then code literals alike, so lengths differ by matches
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                p = zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                )
                d.precompute_compress(compression_params=p)
                made.append(zstandard.ZstdCompressor(compression_params=p, dict_data=d))
            self._pair = tuple(made)
        return self._pair

    def histograms(self, texts: list[str]) -> np.ndarray:
        """Per text, how many windows have each distance (clipped)."""
        width = MAX_DISTANCE - MIN_DISTANCE + 1
        encoded = [t.lower().encode("utf-8", "replace") for t in texts]
        blob = b" " + b"\n".join(encoded) + b" "
        sizes = np.array([len(e) + 1 for e in encoded], dtype=np.int64)
        doc_start = np.cumsum(sizes) - sizes + 1
        start, end, doc = windows(np.frombuffer(blob, np.uint8), doc_start, WINDOW)
        if not len(start):
            return np.zeros((len(texts), width))
        cut = np.stack([start - 1, end - start + 2], axis=1).astype("<u8").tobytes()
        lengths = []
        for c in self.compressors():
            done = c.multi_compress_to_buffer(zstandard.BufferWithSegments(blob, cut), threads=1)
            lengths.append(np.fromiter(map(len, done), dtype=np.int64, count=len(start)))
        distance = np.clip(lengths[0] - lengths[1], MIN_DISTANCE, MAX_DISTANCE) - MIN_DISTANCE
        return np.bincount(doc * width + distance, minlength=len(texts) * width).reshape(-1, width).astype(float)


def _stands_out(a: int, b: int, n1: int, n0: int) -> bool:
    """Log-likelihood ratio and log-odds of a word in ``a`` of ``n1`` toxic
    and ``b`` of ``n0`` ordinary documents."""
    if math.log((a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))) <= MIN_LOG_ODDS:
        return False
    e1, e0 = (a + b) * n1 / (n1 + n0), (a + b) * n0 / (n1 + n0)
    ratio = 2 * (a * math.log(a / e1) + (b * math.log(b / e0) if b else 0))
    return ratio >= MIN_RATIO


def features(hist: np.ndarray) -> np.ndarray:
    n = hist.sum(axis=1, keepdims=True)
    tail = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1][:, [s - MIN_DISTANCE for s in STEPS]]
    length = np.minimum(np.log1p(n), 7) / 5
    return np.concatenate([np.log1p(tail), np.log1p(100 * tail / np.maximum(n, 1)), length], axis=1)


class CompressionDistance:
    """The fitted classifier: two members, each with dictionaries of one half
    of the rows and weights fitted on the other half."""

    def __init__(self, texts: list[str], toxic: list[bool]):
        self.members = []
        for side in (0, 1):
            seen, held = range(side, len(texts), 2), range(1 - side, len(texts), 2)
            y = np.array([toxic[i] for i in held], dtype=float)
            labels = [toxic[i] for i in seen]
            if not any(labels) or all(labels) or y.min(initial=1) == y.max(initial=0):
                continue
            part = Dictionaries([texts[i] for i in seen], labels)
            x = features(part.histograms([texts[i] for i in held]))
            mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            z = np.c_[(x - mean) / scale, np.ones(len(x))]
            w = np.zeros(z.shape[1])
            for _ in range(40):  # ridge logistic regression by Newton's method
                p = 1 / (1 + np.exp(-z @ w))
                w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)), z.T @ (p - y) + w)
            w[-1] -= _best_threshold(z @ w, y)
            self.members.append((part, mean, scale, w))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Sigmoid of the members' mean log-odds."""
        total, distant = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for part, mean, scale, w in self.members:
            x = features(part.histograms(texts))
            total += np.clip(np.c_[(x - mean) / scale, np.ones(len(texts))] @ w, -60, 60) / len(self.members)
            distant |= x[:, 0] > 0
        if not self.members:
            return total
        score = 1 / (1 + np.exp(-total))
        return np.where(distant, score, np.minimum(score, 0.49))  # no distant window: not toxic


def _best_threshold(log_odds: np.ndarray, y: np.ndarray) -> float:
    """The log-odds from which on calling a row toxic gives the largest F1."""
    order = np.argsort(-log_odds, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    at = int(f1.argmax())
    below = log_odds[order[at + 1]] if at + 1 < len(y) else log_odds[order[at]] - 1
    return float(log_odds[order[at]] + below) / 2


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, positive: int = POSITIVE, negative: int = NEGATIVE) -> CompressionDistance:
    """Fit on a bounded sample of the labelled rows where ``learn`` (over
    ``doc_id``) holds.  ``labels`` has doc_id and toxic."""
    labelled = (
        labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
    )
    counts = {r["_toxic"]: r["n"] for r in labelled.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.lit(0)
    for label, want in ((1, positive), (0, negative)):
        share = min(1.0, want / max(1, counts.get(label, 0)))
        bound = F.when(F.col("_toxic") == label, F.lit(int(share * (1 << 31)))).otherwise(bound)
    sample = labelled.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity")), 33) <= bound)
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)) + 1
    rows = (
        docs.select("doc_id", "text")
        .where("text is not null")
        # about positive + negative rows of two numbers: the bound is the parameter
        .join(F.broadcast(sample), "doc_id")
        .select("doc_id", "_toxic", F.xxhash64("text").alias("_h"), F.col("text").substr(start.cast("int"), F.lit(PIECE_CHARS)).alias("_p"))
        .groupBy("doc_id", "_toxic")
        .agg(F.min_by("_p", "_h").alias("_p"), F.min("_h").alias("_h"))
        .collect()
    )
    # copies of one text count once
    texts = {r["_h"]: (r["_p"], bool(r["_toxic"])) for r in sorted(rows, key=lambda r: (r["_h"], r["_toxic"]))}
    ordered = [texts[h] for h in sorted(texts)]
    return CompressionDistance([t for t, _ in ordered], [y for _, y in ordered])


def score(docs: DataFrame, model: CompressionDistance, keep: dict[str, Column], *, text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every row."""
    picked = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("_scored_text"))
    n = len(keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:n])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 300 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        model = shared.value
        for batch in released(batches):
            for lo, hi, texts in text_batches(batch.column(n), BATCH_CHARS):
                s = model.scores([t or "" for t in texts])
                schema = pa.schema([batch.schema.field(i) for i in range(n)] + [("score", pa.float64()), ("predicted", pa.int32())])
                yield record_batch(schema, [*[batch.column(i).slice(lo, hi - lo) for i in range(n)], s, (s >= 0.5).astype(np.int32)])

    return picked.mapInArrow(run, f"{fields}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: CompressionDistance) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    rows, names = neutral(docs)
    kept = score(rows, model, {n: F.col(n) for n in names.values()}, text=names["text"]).where("predicted = 0")
    return named_back(kept, names)


def fit_on_tables(spark: SparkSession, sf_dir: str) -> CompressionDistance:
    return fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from fold mod 5 <> 0."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return score(docs, fit_on_tables(spark, sf_dir), {"doc_id": F.col("doc_id"), "held_out": held})
