"""Word shingles of whole texts as 64-bit hashes, many texts at a time (numpy, inside tasks).

Words are runs of bytes other than space and \\x09-\\x0D, with A-Z lowered. A text's set is
its distinct shingles of `width` words; a shorter text has one shingle, the whole sequence.
Equal word sequences always get equal hashes; that two different ones do is a 64-bit accident.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
# Texts are worked on in slices of about this many bytes; numpy holds some 60 bytes for each.
_SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SEPARATOR] = 0
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_IN_WORD = np.uint64(0x9E3779B97F4A7C15 | 3)
_IN_SHINGLE = np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all 64 positions."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + _SLICE_BYTES, "right")))
        yield first, last
        first = last


def word_hashes(data: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the joined texts, and how many words each text has."""
    is_word = ~_SEPARATOR[data]
    starts_word = is_word.copy()
    starts_word[1:] &= ~is_word[:-1]
    text_starts = np.concatenate([[0], text_ends[:-1]])
    inside = text_starts[text_starts < len(data)]
    starts_word[inside] = is_word[inside]
    starts = np.flatnonzero(starts_word)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(text_ends), dtype=np.int64)
    # A word's stretch reaches up to the next word; the separators in it weigh nothing.
    stretch = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, stretch)
    weights = _powers(_IN_WORD, int(stretch.max()))
    hashes = np.add.reduceat(_BYTE[data[starts[0] :]] * weights[within], starts - starts[0])
    counts = np.searchsorted(starts, text_ends) - np.searchsorted(starts, text_starts)
    return mixed(hashes), counts


def _shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's shingle hashes in text order, repeats included."""
    weights = _powers(_IN_SHINGLE, width)
    rolling = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for step in range(width):
        rolling += words[step : step + len(rolling)] * weights[step]
    rolling = mixed(rolling)
    found, first = [], 0
    for count in counts.tolist():
        if count >= width:
            found.append(rolling[first : first + count - width + 1])
        elif count:
            short = (words[first : first + count] * weights[:count]).sum(dtype=np.uint64)
            found.append(mixed(np.array([short + np.uint64(count)], dtype=np.uint64)))
        else:
            found.append(rolling[:0])
        first += count
    return found


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for a NULL or wordless one."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    lengths = np.diff(offsets)
    for first, last in _slices(lengths):
        part = data[offsets[first] : offsets[last]]
        words, counts = word_hashes(part, offsets[first + 1 : last + 1] - offsets[first])
        for hashes in _shingle_hashes(words, counts, width):
            hashes = np.sort(hashes)
            yield hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes
