"""Words of whole texts as 64-bit fingerprints, cut with numpy straight from Arrow string buffers.

A fingerprint stands for its word everywhere: two different words share one with a chance of about
2^-64. Texts are handled in slices of at most ``SLICE`` bytes, so memory stays bounded for texts of
any length; a longer text is cut at a separator and its slices are joined again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_UP = _powers(_ODD, SLICE + 1)
_DOWN = _powers(pow(_ODD, -1, 1 << 64), SLICE + 1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLDED_BYTE = _BYTE[_FOLD]


def _word_bytes(separators: list[int]) -> np.ndarray:
    table = np.ones(256, bool)
    table[separators] = False
    return table


#: Bytes of a word once A-Z are lower-cased: all but blanks.
NON_BLANK = _word_bytes([9, 10, 11, 12, 13, 32])
#: Digits, letters and everything beyond ASCII (A-Z counts as a-z).
WORD = _word_bytes([b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)])


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more for the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _slice_words(raw: np.ndarray, begins: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of at most SLICE bytes, and the place where each word begins."""
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = table[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = begins[(begins > 0) & (begins < len(raw))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_FOLDED_BYTE[raw] * _UP[: len(raw)], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * _DOWN[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(_ODD)), starts


def _long_words(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Words of one text of more than SLICE bytes."""
    parts, at = [], 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        if end < len(raw):
            blanks = np.flatnonzero(~table[raw[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:  # one word longer than a slice: chain the fingerprints of its pieces
                word = np.uint64(0)
                while at < len(raw) and table[raw[at]]:
                    stop = min(at + SLICE, len(raw))
                    blanks = np.flatnonzero(~table[raw[at:stop]])
                    stop = at + int(blanks[0]) if len(blanks) else stop
                    piece, _ = _slice_words(raw[at:stop], np.zeros(1, np.int64), table)
                    word = mix(np.array([word], np.uint64) + piece[:1])[0]
                    at = stop
                parts.append(np.array([word], np.uint64))
                continue
        parts.append(_slice_words(raw[at:end], np.zeros(1, np.int64), table)[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def words(column: pa.Array | pa.ChunkedArray, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, number of words of each row, fingerprints of all their words).

    A null text has no words.
    """
    raw, bounds = utf8(column)
    row, n = 0, len(bounds) - 1
    while row < n:
        stop = int(np.searchsorted(bounds, bounds[row] + SLICE, side="right")) - 1
        if stop <= row:  # longer than a slice
            found = _long_words(raw[bounds[row] : bounds[row + 1]], table)
            yield row, np.array([len(found)]), found
            row += 1
            continue
        found, starts = _slice_words(raw[bounds[row] : bounds[stop]], bounds[row:stop] - bounds[row], table)
        yield row, np.diff(np.searchsorted(starts, bounds[row : stop + 1] - bounds[row])), found
        row = stop


def fingerprint(word: str, table: np.ndarray = NON_BLANK) -> int:
    """Fingerprint of one word, as a signed number (for tests and look-ups)."""
    found = [x for _, _, h in words(pa.array([word]), table) for x in h.view(np.int64)]
    return int(found[0])
