"""Byte-level BPE encoding and decoding by forced-boundary splitting.

Method.  A pair of neighbouring bytes that occurs inside no vocabulary token
can never end up inside one token, so there is a certain cut between them.
A pre-token is cut at all such pairs; the fragments are encoded
independently (lowest merge rank first) and their ids concatenated.  Merges
never cross a certain cut, hence the result is that of encoding the
pre-token whole.

Character classes differ between Unicode versions.  The pattern here cuts
chunks of ``PROVEN`` characters alone, on which it agrees with the public
library; any other chunk is cut by the library's own pre-tokeniser, and its
pre-tokens are split and merged like all others.

Fragments and white-space-led chunks repeat a lot, so both are kept in
bounded tables per Python worker.  A full table forgets what was not met of
late, which costs time and changes no result; so a worker's memory does not
grow with the words of its texts.

Cases.  A null text counts as empty: no ids, empty decoded text.  Special
tokens written out in a text become their id, as in the public library with
``add_special_tokens=False``.  Rows are independent: repeated rows, ties and
very long texts need nothing special (a fragment of n bytes costs
O(n log n)); other columns of the input are ignored unless named in
``keep``.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from monthwise.llm.common import kept_in_worker, read_table, record_batch, released, text_batches

#: Unicode White_Space, as the public library's patterns read \s (fixed value).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The public byte-level pre-token pattern (fixed value).
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Unions of pre-tokens that are cheap to find: a word with its leading space, or white space.
CHUNK = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Characters whose classes, case and compositions no Unicode version changes
#: (scripts long complete); tests/llm/test_bpe_files.py tries them all.
PROVEN = "\\x00-\u052f\u2010-\u2027\u2030-\u205e\u20a0-\u20bd\u3000-\u30ff\u4e00-\u9fcc\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f64f"

TABLE_LIMIT = 300_000
NO_MERGE = 1 << 62
BATCH_CHARS = 1_000_000


def byte_alphabet() -> list[str]:
    """The public byte-to-character mapping: printable Latin-1 stays, the
    other bytes follow from code point 256 upwards."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, extra = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in chars:
            chars[b] = chr(extra)
            extra += 1
    return [chars[b] for b in range(256)]


class RecentTable:
    """At most ``limit`` results by key, in two generations: a key met again
    in the old one moves to the young one, and a full young one becomes the
    old one, whose keys not met meanwhile go."""

    def __init__(self, limit: int):
        self.half = max(1, limit // 2)
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.young.get(key)
        if got is None and (got := self.old.pop(key, None)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


class ForcedBoundaryBpe:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str, table_limit: int = TABLE_LIMIT):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        self._library = Tokenizer.from_file(path).pre_tokenizer
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        self._raw = raw = lambda token: bytes(to_byte[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # (left id, right id) -> rank and merged id in one number, so that the
        # smallest number is the merge to make
        self.merges = {
            (vocab[raw(a)], vocab[raw(b)]): rank << 24 | vocab[raw(a) + raw(b)] for rank, (a, b) in enumerate(merges)
        }
        self.byte_ids = [vocab[bytes([b])] for b in range(256)]
        #: byte pairs that occur inside a token; any other pair is a certain cut
        self.inside = {pair for token in vocab for pair in zip(token, token[1:])}
        special = {a["content"]: a["id"] for a in spec.get("added_tokens", []) if a.get("special")}
        self.special = special
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._chunks, self._tokens = re.compile(CHUNK), regex.compile(PRE_TOKEN)
        self._unproven = re.compile(f"[^{PROVEN}]")
        size = max([*vocab.values(), *special.values()], default=0) + 1
        surface = [b""] * size
        for token, i in vocab.items():
            surface[i] = token
        for text, i in special.items():
            surface[i] = text.encode()
        self._length = np.array([len(s) for s in surface], dtype=np.int64)
        self._start = np.concatenate([[0], np.cumsum(self._length)[:-1]])
        self._surface = np.frombuffer(b"".join(surface), np.uint8)
        self._fragment_table = RecentTable(table_limit)
        self._chunk_table = RecentTable(table_limit)

    def fragments(self, token: bytes) -> list[bytes]:
        """``token`` cut at every byte pair that no vocabulary token holds."""
        cuts = [i for i, pair in enumerate(zip(token, token[1:]), 1) if pair not in self.inside]
        return [token[a:b] for a, b in zip([0, *cuts], [*cuts, len(token)])] if cuts else [token]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of one fragment: the lowest-ranked pair is merged first, the
        leftmost of equal ones."""
        ids = [self.byte_ids[b] for b in fragment]
        if len(ids) > 48:
            return self._merge_long(ids)
        get, none = self.merges.get, NO_MERGE
        found = [get(pair, none) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) != none:
            at = found.index(best)
            ids[at] = merged = best & 0xFFFFFF
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = get((ids[at - 1], merged), none)
            if at < len(found):
                found[at] = get((merged, ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: O(n log n)."""
        merges, n = self.merges, len(ids)
        after, before, heap = [*range(1, n), -1], [-1, *range(n - 1)], []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := merges.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found >> 24, i, ids[i], ids[j], found & 0xFFFFFF))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def _fragment(self, fragment: bytes) -> bytes:
        got = self._fragment_table.get(fragment)
        if got is None:
            got = array("I", self.merge(fragment)).tobytes()
            if len(fragment) <= 64:
                self._fragment_table.put(fragment, got)
        return got

    def _chunk(self, chunk: str) -> bytes:
        got = self._chunk_table.get(chunk)
        if got is not None:
            return got
        if not chunk.isascii() and self._unproven.search(chunk):
            tokens = [self._raw(t) for t, _ in self._library.pre_tokenize_str(chunk)]
        elif chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            tokens = [chunk.encode()]
        else:
            tokens = [t.encode() for t in self._tokens.findall(chunk)]
        out = [self._fragment(f) for t in tokens for f in self.fragments(t)]
        got = out[0] if len(out) == 1 else b"".join(out)
        if len(chunk) <= 64:
            self._chunk_table.put(chunk, got)
        return got

    def _plain(self, text: str) -> bytes:
        get, miss = self._chunk_table.young.get, self._chunk
        return b"".join([get(c) or miss(c) for c in self._chunks.findall(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._special is None or "<|" not in text and not self._special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [self._plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ``ids`` before UTF-8 decoding: one gather over the
        concatenated surfaces of the vocabulary."""
        lengths = self._length[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        shift = np.repeat(self._start[ids] - (ends - lengths), lengths)
        return self._surface[shift + np.arange(ends[-1])].tobytes()


def encoder(path: str) -> ForcedBoundaryBpe:
    """The encoder of a vocabulary file, made once per Python worker and stage."""
    return kept_in_worker(("bpe", path), lambda: ForcedBoundaryBpe(path))


def bpe_encode_decode(
    docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False
) -> DataFrame:
    """Per row of ``docs``: the columns of ``keep``, ``n_tokens`` and either
    ``ids`` (array of int) with ``decoded`` (the text that the ids stand
    for), or with ``digests`` their SHA-256 instead."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    more = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in released(batches):
            for lo, hi, texts in text_batches(batch.column(len(keep)), BATCH_CHARS):
                counts, first, second = [], [], []
                for t in texts:
                    raw = enc.encode(t)
                    ids = np.frombuffer(raw, "<u4")
                    decoded = enc.decode(ids)
                    try:
                        decoded.decode()
                    except UnicodeDecodeError:
                        decoded = decoded.decode("utf-8", "replace").encode()
                    counts.append(len(ids))
                    if digests:
                        first.append(hashlib.sha256(raw).hexdigest())
                        second.append(hashlib.sha256(decoded).hexdigest())
                    else:
                        first.append(ids.astype(np.int32))
                        second.append(decoded.decode())
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                schema = pa.schema(
                    [batch.schema.field(i) for i in range(len(keep))]
                    + [pa.field("n_tokens", pa.int64())]
                    + (
                        [pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
                        if digests
                        else [pa.field("ids", pa.list_(pa.int32())), pa.field("decoded", pa.string())]
                    )
                )
                yield record_batch(schema, [*kept, counts, first, second])

    return docs.select(*keep, text).mapInArrow(run, f"{fields}, n_tokens bigint, {more}")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe_encode_decode(read_table(spark, sf_dir, "documents"), byte_bpe_path(), digests=True)
