"""Vectorised word hashing over Arrow text columns, used inside Arrow tasks.

A word is a maximal run of word bytes of the UTF-8 text. Every word gets a
64-bit polynomial hash of its bytes (A-Z lower-cased), taken from prefix sums,
so no Python code runs per word. Texts are worked in blocks of ``BLOCK`` bytes;
a word that crosses a block edge is put together from its parts, so temporary
arrays stay small however long a text or a word is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table(*spans: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = False
    return table


# bytes that belong to words
NOT_SPACE = _table((0x20, 0x20), (0x09, 0x0D))
ALNUM = _table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def _powers(base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(BLOCK, base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(_BASE_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all of its bits depend on all of its input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column, without a copy."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    size = 8 if wide else 4
    _, at, data = column.buffers()
    if at is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32, len(column) + 1, column.offset * size)
    bytes_ = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return bytes_, offsets.astype(np.int64)


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the hash terms of at most ``BLOCK`` bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _UP[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of the bytes behind ``sums``; they depend on the bytes alone, not on the place."""
    return mix((sums[ends] - sums[starts]) * _DOWN[starts])


def _block(data: np.ndarray, cuts: np.ndarray, word_byte: np.ndarray, prefix: int):
    """Starts, ends, raw hashes and raw prefix hashes of the words of one block; words end at ``cuts``."""
    text = _LOWER[data]
    inside = word_byte[text]
    n = len(text)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = byte_sums(text)
    low = sums[starts]
    hashes = (sums[ends] - low) * _DOWN[starts]
    heads = (sums[np.minimum(ends, starts + prefix)] - low) * _DOWN[starts] if prefix else None
    return starts, ends, hashes, heads


def document_words(column: pa.Array, word_byte: np.ndarray, prefix: int = 0) -> Iterator[tuple]:
    """Slices of rows with their words: (first row, word offsets by row, hashes, prefix hashes).

    ``hashes`` holds the words of all rows of the slice one after another, row
    ``i`` of the slice has ``hashes[offsets[i]:offsets[i + 1]]``. ``prefix`` also
    asks for hashes of the first ``prefix`` bytes of each word. A slice holds
    about ``BLOCK`` bytes of text, or one row that is longer.
    """
    data, offsets = buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        begin, end = int(offsets[row]), int(offsets[stop])
        if end - begin <= BLOCK:
            cuts = offsets[row : stop + 1] - begin
            starts, _, hashes, heads = _block(data[begin:end], cuts, word_byte, prefix)
            yield row, np.searchsorted(starts, cuts), mix(hashes), mix(heads) if prefix else None
        else:
            hashes, heads = _long_text(data[begin:end], word_byte, prefix)
            yield row, np.array([0, len(hashes)]), hashes, heads
        row = stop


def _long_text(data: np.ndarray, word_byte: np.ndarray, prefix: int):
    """Word hashes of one text that is longer than a block."""
    found, found_heads = [], []
    none = np.empty(0, np.int64)
    carried, length, head, head_length = 0, 0, 0, 0  # the word that the last block left open
    for begin in range(0, len(data), BLOCK):
        block = data[begin : begin + BLOCK]
        starts, ends, hashes, heads = _block(block, none, word_byte, prefix)
        open_end = bool(len(ends)) and ends[-1] == len(block) and begin + BLOCK < len(data)
        if length:
            if len(starts) and starts[0] == 0:
                if head_length < prefix:  # the prefix itself crosses the edge
                    take = int(min(prefix - head_length, ends[0]))
                    part = sum(int(_BYTE[_LOWER[b]]) * pow(_BASE, i, 1 << 64) for i, b in enumerate(block[:take]))
                    head = (head + pow(_BASE, head_length, 1 << 64) * part) % (1 << 64)
                    head_length += take
                hashes[0] = (carried + pow(_BASE, length, 1 << 64) * int(hashes[0])) % (1 << 64)
                if prefix:
                    heads[0] = head
                length += int(ends[0])
            else:
                found.append(np.array([carried], np.uint64))
                found_heads.append(np.array([head], np.uint64))
                length = 0
        if open_end:
            if len(starts) > 1 or not length:
                length = int(ends[-1] - starts[-1])
                head_length = min(prefix, length)
            carried, head = int(hashes[-1]), int(heads[-1]) if prefix else 0
            hashes, heads = hashes[:-1], heads[:-1] if prefix else None
        else:
            length = 0
        found.append(hashes)
        found_heads.append(heads)
    return mix(np.concatenate(found)), mix(np.concatenate(found_heads)) if prefix else None


def ngrams(words: np.ndarray, n: int, gap: int = 1) -> np.ndarray:
    """Hashes of ``n`` words that stand ``gap`` apart, for every start."""
    count = max(0, len(words) - (n - 1) * gap)
    total = words[:count].copy()
    factor = 1
    for i in range(1, n):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total += words[i * gap : i * gap + count] * np.uint64(factor)
    return mix(total)
