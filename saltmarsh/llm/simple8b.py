"""Simple-8b word-aligned coding of unsigned integers, vectorised over blocks.

A 64-bit word holds a selector in its top four bits and in the rest as many equal-width values as the
selector says. Values come in blocks of `BLOCK`; each block starts at a word of its own, whose
place is kept in a list of offsets, so blocks are packed and unpacked side by side. Selector 15 is an
escape: the next whole word is one value of 60 bits or more. The last word of a block may have fewer
values than its selector says (the rest are zero bits and are not counted).
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
#: Fixed values of the format: values in a word, and bits of each, by selector; 15 escapes.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
# selectors as stored: 0 to 14 pack, 15 escapes; the 60-bit single takes the place of the 120-zeros run
COUNTS, WIDTHS = np.delete(COUNTS, 1), np.delete(WIDTHS, 1)
ESCAPE = 15


_SHORT = np.array([x.bit_length() for x in range(1 << 16)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Number of bits of each value."""
    if values.max(initial=0) < len(_SHORT):
        return _SHORT[values]
    high = values >> np.uint64(16)
    return np.where(high, 16 + _bits(high).astype(np.int16), _SHORT[values & np.uint64(0xFFFF)]).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of the blocks (rows of `bits`, zero-padded) the selector that takes most values from there on."""
    blocks = len(bits)
    flat, most = bits.reshape(-1), int(bits.max(initial=0))
    always = int(np.argmax(WIDTHS >= most)) if most <= 60 else ESCAPE
    best = np.full(flat.shape, always, np.int8)
    table = best.reshape(blocks, BLOCK)
    tail = np.maximum.accumulate(bits[:, ::-1], axis=1)[:, ::-1]
    for s in range(min(always, len(COUNTS)) - 1 if always != ESCAPE else len(COUNTS) - 1, -1, -1):
        n, width = int(COUNTS[s]), int(WIDTHS[s])
        fits = np.flatnonzero(flat <= width)
        if len(fits) >= n:  # n fitting places in a row, all in one block
            begin = fits[: len(fits) - n + 1]
            begin = begin[(fits[n - 1 :] - begin == n - 1) & (begin % BLOCK <= BLOCK - n)]
            best[begin] = s
        last = table[:, max(0, BLOCK - n + 1) :]
        last[tail[:, max(0, BLOCK - n + 1) :] <= width] = s  # all that are left fit
    return table


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the values (uint64), and each block's first word with their number as a last item."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    blocks = -(-n // BLOCK)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = values
    bits = _bits(flat)
    best = _selectors(bits.reshape(blocks, BLOCK))
    held = np.full(blocks, BLOCK, np.int64)
    held[-1] = n - (blocks - 1) * BLOCK
    take = np.append(COUNTS, 1)
    at, row, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(row):
        s = best[row, at]
        steps.append((row, at, s))
        at = at + take[s]
        on = at < held[row]
        at, row = at[on], row[on]
    step = np.repeat(np.arange(len(steps)), [len(x[0]) for x in steps])
    row, at, s = (np.concatenate(x) for x in zip(*steps, strict=True))
    size = np.where(s == ESCAPE, 2, 1)
    if (size == 1).all():
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=blocks))))
        to = offsets[row] + step
    else:
        order = np.lexsort((step, row))
        to = np.empty(len(row), np.int64)
        to[order] = np.cumsum(size[order]) - size[order]
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row, size, blocks)))).astype(np.int64)
    words = np.zeros(offsets[-1], np.uint64)
    words[to] = s.astype(np.uint64) << np.uint64(60)
    place = row * BLOCK + at
    padded = np.concatenate((flat, np.zeros(BLOCK, np.uint64)))
    room = (row + 1) * BLOCK
    for one in np.unique(s).tolist():
        here = np.flatnonzero(s == one)
        if one == ESCAPE:
            words[to[here] + 1] = flat[place[here]]
        elif WIDTHS[one]:
            first, word = place[here], words[to[here]]
            short = first + COUNTS[one] > room[here]
            for j in range(int(COUNTS[one])):
                v = padded[first + j]
                if short.any():
                    v[first + j >= room[here]] = 0
                word |= v << np.uint64(j * int(WIDTHS[one]))
            words[to[here]] = word
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values of the words; offsets as `pack` gives them."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():
        # words after an escape are values, not packed: of a run of words that look like escapes every second one is
        looks = selector == ESCAPE
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(looks):
            if not raw[i] and i + 1 < len(words):
                raw[i + 1] = True
    else:
        raw = np.zeros(len(words), bool)
    count = np.append(COUNTS, 1)[selector]
    count[raw] = 0
    starts = np.asarray(offsets[:-1], np.int64)
    before = np.concatenate(([0], np.cumsum(count)))
    block = np.searchsorted(starts, np.arange(len(words)), side="right") - 1
    first = before[:-1] - before[starts][block] + block * BLOCK
    limit = np.minimum((block + 1) * BLOCK, n)
    mask = {int(w): np.uint64((1 << int(w)) - 1) for w in WIDTHS}
    for s in range(len(COUNTS)):
        here = np.flatnonzero((selector == s) & ~raw)
        if not len(here) or WIDTHS[s] == 0:
            continue
        width, k = int(WIDTHS[s]), int(COUNTS[s])
        got = (words[here][:, None] >> (np.arange(k, dtype=np.uint64) * np.uint64(width))[None, :]) & mask[width]
        to = first[here][:, None] + np.arange(k)[None, :]
        fits = to < limit[here][:, None]
        out[to[fits]] = got[fits]
    for i in np.flatnonzero((selector == ESCAPE) & ~raw):
        out[first[i]] = words[i + 1]
    return out
