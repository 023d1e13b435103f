"""Simple-8b word-aligned coding of unsigned integers, vectorised.

Each 64-bit word has a 4-bit selector in its top bits and 60 bits of values,
the first value lowest.  Selector ``s`` packs ``COUNTS[s]`` values of
``WIDTHS[s]`` bits; selectors 0 and 1 stand for runs of 240 and 120 zeros.
Selector ``ESCAPE`` holds no value: the whole next word is one raw value
(for values of over 60 bits).  The last word of a block may be part full;
the block's count says how many values are real.

A stream is cut into blocks of ``BLOCK`` values.  ``word_start`` gives the
word offset of each block, so that a reader can start at any block, and the
encoder packs all blocks side by side (one NumPy lane per block).
"""

from __future__ import annotations

import numpy as np

#: Values and bits per selector (fixed values of the format).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 1024
#: One value of 60 bits uses selector 15; a wider one uses selector 14 with
#: its two 30-bit fields both all ones, then the raw word.
ESCAPE_WORD = np.uint64((14 << 60) | ((1 << 60) - 1))
_ESCAPED_PAIR = np.uint64((1 << 30) - 1)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each unsigned 64-bit value."""
    if int(values.max()) < 1 << 32:  # exact as floats, whose exponent is the bit length
        exponent = values.astype(np.float64).view(np.int64) >> 52
        return np.maximum(exponent - 1022, 0).astype(np.uint8)
    out, rest, shift = np.zeros(len(values), dtype=np.uint8), values.copy(), 32
    while shift:
        big = rest >= np.uint64(1 << shift)
        out += big.view(np.uint8) * np.uint8(shift)
        rest >>= big.astype(np.uint64) * np.uint64(shift)
        shift //= 2
    return out + (rest > 0)


def _selectors(bits: np.ndarray, block: int) -> np.ndarray:
    """The selector of the word that would start at each value (16: escape).
    What fits a selector fits all higher ones too, so the selector is 16 less
    the number of those that it fits."""
    n, widest, narrowest = len(bits), int(bits.max()), int(bits.min())
    rows, whole, wide = -(-n // block), n // block, block + int(COUNTS[0])
    # a row a block; the zeros behind it fit any width, as no value is there
    padded = np.zeros((rows, wide), np.uint8)
    padded[:whole, :block] = bits[: whole * block].reshape(whole, block)
    padded[whole:, : n - whole * block] = bits[whole * block :]
    padded = padded.ravel()
    selector = np.full(rows * wide, 16 - int((WIDTHS >= widest).sum()), dtype=np.uint8)
    for s in np.flatnonzero((WIDTHS < widest) & (WIDTHS >= narrowest)):
        fits, have, count = padded <= np.uint8(WIDTHS[s]), 1, int(COUNTS[s])
        while have < count:  # fits: of the next ``have`` values each
            more = min(have, count - have)
            fits = fits[:-more] & fits[more:]
            have += more
        selector[: len(fits)] -= fits.view(np.uint8)
    return selector.reshape(rows, wide)[:, :block].ravel()[:n]


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``values`` (unsigned) as words, and the word offset of each block."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.zeros(n + int(COUNTS[0]), np.uint64)
    padded[:n] = values
    values = padded[:n]
    selector = _selectors(_bits(values), block)
    # two full 30-bit values would read as the escape word: leave them to selector 15
    full = values == _ESCAPED_PAIR
    if full.any():
        pair = np.zeros(n, bool)
        pair[:-1] = full[:-1] & full[1:]
        selector[(selector == 14) & pair] = 15
    # all blocks in step: each round goes on by one word in every block; a block that is done stays at n
    block_start = np.arange(0, n, block)
    block_end = np.minimum(block_start + block, n)
    kind = np.int32 if n < 1 << 30 else np.int64
    jump = np.arange(n + 1, dtype=kind)
    jump[:n] += np.append(COUNTS, 1).astype(kind)[selector]
    jump[:n][jump[:n] >= np.repeat(block_end.astype(kind), block_end - block_start)] = n
    at, rounds = block_start, []
    while (at < n).any():
        for _ in range(16):
            rounds.append(at)
            at = jump[at]
    starts = np.zeros(n + 1, dtype=bool)
    starts[np.concatenate(rounds)] = True
    start = np.flatnonzero(starts[:n])
    left = block_end[start // block] - start
    sel = selector[start]
    n_words = np.where(sel == 16, 2, 1)
    where = np.cumsum(n_words) - n_words
    words = np.zeros(int(n_words.sum()), dtype=np.uint64)
    for s in range(16):
        rows = np.flatnonzero(sel == s)
        if not len(rows):
            continue
        packed = np.full(len(rows), s << 60, dtype=np.uint64)
        if WIDTHS[s]:
            k = np.arange(int(COUNTS[s]))[:, None]
            value = padded[start[rows] + k]
            short = np.flatnonzero(left[rows] < COUNTS[s])  # a block's last word: no values of the next block
            value[:, short] *= k < left[rows[short]]
            packed |= np.bitwise_or.reduce(value << (k * WIDTHS[s]).astype(np.uint64), axis=0)
        words[where[rows]] = packed
    rows = np.flatnonzero(sel == 16)
    words[where[rows]] = ESCAPE_WORD
    words[where[rows] + 1] = values[start[rows]]
    return words, where[np.searchsorted(start, block_start)]


def decode(words: np.ndarray, word_start: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of a stream.  Blocks may be decoded on their own by
    passing a slice of the words and offsets."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    # a raw word follows an escape word; an escape word itself may be a raw value's bits,
    # so pairs are resolved in order within each run of escape words
    is_escape = words == ESCAPE_WORD
    raw = np.zeros(len(words), dtype=bool)
    for i in np.flatnonzero(is_escape):
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    head = ~raw
    index = np.flatnonzero(head)
    sel = (words[index] >> np.uint64(60)).astype(np.int64)
    escaped = is_escape[index]
    counts = np.where(escaped, 1, COUNTS[sel])
    # a block's last word holds only what is left of the block
    block_of = np.searchsorted(word_start, index, side="right") - 1
    cum = np.cumsum(counts)
    before = cum - counts
    block_first = before[np.searchsorted(index, word_start)]
    in_block = before - block_first[block_of]
    sizes = np.minimum(block, n - np.arange(len(word_start)) * block)
    real = np.minimum(counts, sizes[block_of] - in_block)
    target = block_of * block + in_block
    out = np.zeros(n, dtype=np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero((sel == s) & ~escaped)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])) if len(rows) else ():
            live = rows[real[rows] > k]
            out[target[live] + k] = (words[index[live]] >> np.uint64(k * int(WIDTHS[s]))) & mask
    rows = np.flatnonzero(escaped)
    out[target[rows]] = words[index[rows] + 1]
    return out
