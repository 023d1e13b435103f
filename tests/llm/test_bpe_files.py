"""BPE and token files against the tokenizers library; Simple-8b round trips."""

import hashlib
import random
import time
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from monthwise.llm import common, simple8b
from monthwise.llm.bpe import ForcedBoundaryBpe, RecentTable, bpe_encode_decode, byte_bpe_path, encoder
from monthwise.llm.token_files import WordEncoder, read_token_files, word_bpe_path, write_token_files

from .helpers import documents

PIECES = ["a", "B", "the", " ", "  ", "\n", "\t", "'s", "'LL", "'", "!", "é", "é", "İ", "ΑΣ", "日本", "1", "23", "\x1c", "\x85",
          "\xa0", "　", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "ſ", "Ⅷ", "\x00", "﻿", "²", "_", "foo.", "Bar,"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path,make", [(byte_bpe_path(), ForcedBoundaryBpe), (word_bpe_path(), WordEncoder)])
def test_encoders_equal_the_library(path, make):
    ours, library = make(path, table_limit=500), Tokenizer.from_file(path)
    texts = [*odd_texts(3000, 1), "", "ab" * 3000 + "a" * 500, "x" * 200, "word " * 50]
    for text in texts:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert ours.encode(None) == b""


@pytest.mark.parametrize("path,make", [(byte_bpe_path(), ForcedBoundaryBpe), (word_bpe_path(), WordEncoder)])
def test_every_code_point_equals_the_library(path, make):
    """Alone, and next to letters, digits, spaces and marks, also where
    Unicode versions differ."""
    ours, library = make(path), Tokenizer.from_file(path)
    scripts = [range(0x3400), range(0xA000, 0xAC00), range(0xF900, 0x13000), range(0x18C00, 0x19000), range(0x1C000, 0x1FC00)]
    uniform = [range(0x3400, 0xA000, 61), range(0xAC00, 0xD800, 61), range(0x13000, 0x32000, 61), range(0xE0000, 0xE0200, 7)]
    codes = [c for r in [*scripts, *uniform] for c in r]
    form = "{0} a{0} {0}a 1{0}1  {0} {0}漢 {0}\u0327\u0301 {0}\n{0}A"
    texts = [form.format(chr(c)) for c in codes]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    wrong = [c for c, t, w in zip(codes, texts, want) if np.frombuffer(ours.encode(t), "<u4").tolist() != w.ids]
    assert wrong == []


def test_tables_do_not_mix_words_and_pieces():
    """A lower-cased piece may compose if it is met as a word."""
    ours, library = WordEncoder(word_bpe_path()), Tokenizer.from_file(word_bpe_path())
    for text in ["J\u030c", "j\u030c", "\u0130\u0327", "i\u0307\u0327", "H\u0331", "h\u0331", "T\u0308", "t\u0308"]:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_words_of_letters_and_marks_skip_the_pattern():
    """In any script; the pattern is slow, and these are most of the new words."""
    ours, library = WordEncoder(word_bpe_path()), Tokenizer.from_file(word_bpe_path())
    ours._pieces = None
    text = "naïve Größe, ÄPFEL.\nпривет!! 日本語 cafe\u0301 word### ΑΣ; it"
    assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    with pytest.raises(AttributeError):
        ours.encode("it's")


def test_table_keeps_what_is_met_again():
    table, fixed = RecentTable(10), ForcedBoundaryBpe(byte_bpe_path(), table_limit=50)
    table.put("often", 1)
    for i in range(1000):
        table.put(i, i)
        assert table.get("often") == 1 and len(table.young) + len(table.old) <= 10
    assert table.get(0) is None and table.get(999) == 999
    for i in range(500):
        fixed.encode(f"word{i} {i}x{i} often")
        for t in (fixed._chunk_table, fixed._fragment_table):
            assert len(t.young) + len(t.old) <= 50


def test_a_worker_keeps_the_model_of_one_operator():
    """Spark reuses Python workers: the BPE tables may not stay for the next stage."""
    held = weakref.ref(encoder(byte_bpe_path()))
    assert encoder(byte_bpe_path()) is held()
    assert common.kept_in_worker("other", list) == [] and held() is None
    held = weakref.ref(encoder(byte_bpe_path()))
    common.forget_kept()
    assert held() is None


def test_text_batches_are_the_ranges_of_char_batches():
    for texts in ([], [None], ["ab", None, "é😀" * 3, "", "x" * 50, "c", "d" * 9, None]):
        column = pa.array(["cut", *texts], pa.string()).slice(1)
        got = list(common.text_batches(column, 10))
        assert [(lo, hi) for lo, hi, _ in got] == list(common.char_batches(texts, 10))
        assert [t for _, _, part in got for t in part] == texts
        batches = [pa.record_batch([column], ["text"])] * 2
        assert [b.num_rows for b in common.released(iter(batches))] == [len(texts)] * 2


def test_decode_equals_the_library():
    ours, library = ForcedBoundaryBpe(byte_bpe_path()), Tokenizer.from_file(byte_bpe_path())
    rng = np.random.default_rng(2)
    for _ in range(200):  # any ids, so that broken UTF-8 is met too
        ids = rng.integers(0, 50257, rng.integers(0, 8))
        assert ours.decode(ids).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_fragments_cut_only_where_no_token_goes():
    enc = ForcedBoundaryBpe(byte_bpe_path())
    for text in odd_texts(300, 3):
        raw = text.encode()
        if raw:
            parts = enc.fragments(raw)
            assert b"".join(parts) == raw
            assert all((a[-1], b[0]) not in enc.inside for a, b in zip(parts, parts[1:]))


def test_bpe_table(spark):
    rows = [(1, "Hello world"), (2, None), (None, ""), (1, "Hello world"), (3, "a" * 30_000 + " é")]
    docs = documents(spark, rows, "ids n_tokens _t")
    out = bpe_encode_decode(docs, byte_bpe_path()).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in out) == sorted((str(d), t or "") for d, t in rows)
    library = Tokenizer.from_file(byte_bpe_path())
    for r in out:
        assert list(r.ids) == library.encode(r.decoded, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    digests = bpe_encode_decode(docs, byte_bpe_path(), digests=True).where("doc_id = 1").first()
    ids = np.array(library.encode("Hello world").ids, "<u4").tobytes()
    assert digests.ids_sha256 == hashlib.sha256(ids).hexdigest()
    assert digests.decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest()
    assert bpe_encode_decode(docs.limit(0), byte_bpe_path()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("high", [1, 2, 100, 50_000, 2**30, 2**60, 2**64 - 1])
def test_simple8b_round_trip(n, high):
    values = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    if n > 10 and high > 2**30:
        values[3:7] = 2**30 - 1  # would read as an escape
    if n > 1000 and high > 2**60:
        values[500:504] = simple8b.ESCAPE_WORD
    if n > 1000:
        values[100:700] = 0
    for block in (1024, 64):
        words, starts = simple8b.encode(values, block)
        assert (simple8b.decode(words, starts, n, block) == values).all()
        if len(starts) > 2:  # from a block in the middle
            tail = simple8b.decode(words[starts[1] :], starts[1:] - starts[1], n - block, block)
            assert (tail == values[block:]).all()


def test_simple8b_encodes_about_as_fast_as_it_decodes():
    ids = (2.0 ** np.random.default_rng(7).uniform(1, 15.6, 65_536)).astype("<u4")
    words, starts = simple8b.encode(ids)

    def least(run):
        took = []
        for _ in range(15):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: simple8b.encode(ids)) < 3 * least(lambda: simple8b.decode(words, starts, len(ids)))


def test_token_files(spark, scratch):
    rows = [(5, "five Five"), (2, None), (None, "null id"), (9, "nine " * 300), (2, "two"), (2, "two"), (-1, "x\ny")]
    docs = documents(spark, rows, "start part")
    root = scratch("token_files")
    write_token_files(docs, root, word_bpe_path(), 1, block_ids=16, parts=3)
    out = read_token_files(spark, root).orderBy("start").collect()
    library = Tokenizer.from_file(word_bpe_path())
    want = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows}
    assert [r.doc_id for r in out] == [None, -1, 2, 2, 2, 5, 9]
    assert sorted(list(r.ids) for r in out) == sorted(want[t] for _, t in rows)
    at = 0
    for r in out:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    crc = {r.start: r.ids_crc32 for r in read_token_files(spark, root, digests=True).collect()}
    assert all(crc[r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out)
    empty = scratch("token_files")
    write_token_files(docs.limit(0), empty, word_bpe_path(), 1)
    assert read_token_files(spark, empty).count() == 0
