"""Words, word hashes and character n-grams of whole Arrow batches, without a Python loop over words.

A word is what stands between white space, in lower case. Hashes are 64 bits wide.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GOLD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x9E3779B97F4A7C15
#: Bytes of text taken at once; several times as many are held while their words are looked at.
AT_ONCE = 1 << 20
#: Bytes whose running sums are held at once, whatever the length of a text.
WINDOW = 1 << 16


@dataclass
class Words:
    """codes: index into vocabulary for every word of every text; starts: first word of each text, one more at the end."""

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: list[str]


def words_of(texts: pa.Array) -> Words:
    """The words of a batch of texts; a missing text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(texts)))
    starts = np.asarray(lists.offsets, np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    coded = flat.cast(pa.large_string()).dictionary_encode()
    codes = np.asarray(coded.indices, np.int64)
    vocabulary = coded.dictionary.to_pylist()
    keep = np.fromiter((bool(w) and not w.isspace() for w in vocabulary), bool, len(vocabulary))
    if not keep.all():
        stays = keep[codes]
        starts = np.concatenate([[0], np.cumsum(stays)])[starts]
        codes = codes[stays]
    return Words(codes, starts, vocabulary)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x * GOLD


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


#: Characters of two and three UTF-8 bytes that are white space, dashes that part words, and punctuation.
BLANKS = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
DASHES = "\u2012\u2013\u2014\u2015"
MARKS = (
    "".join(c for c in map(chr, range(0xA1, 0xC0)) if not c.isalnum())
    + "".join(c for c in map(chr, [*range(0x200B, 0x2060), *range(0x3001, 0x3021), 0xFEFF]) if c not in BLANKS + DASHES and not c.isalnum()))


def _codes(characters: str) -> dict[int, np.ndarray]:
    """By number of bytes: the sorted UTF-8 codes of the characters as numbers."""
    by: dict[int, list[int]] = {}
    for c in characters:
        by.setdefault(len(c.encode()), []).append(int.from_bytes(c.encode(), "big"))
    return {size: np.array(sorted(codes), np.uint32) for size, codes in by.items()}


def ascii_parted(data: np.ndarray, plain: bool) -> np.ndarray:
    """UTF-8 bytes in which white space beyond ASCII is written as spaces; with `plain` dashes too, and punctuation as '!'. Lengths stay."""
    out = data
    for characters, code in ((BLANKS, 32), *(((DASHES, 32), (MARKS, 33)) if plain else ())):
        for size, wanted in _codes(characters).items():
            leads = np.unique((wanted >> np.uint32(8 * (size - 1))).astype(np.uint8))
            spots = np.flatnonzero(np.isin(data[: len(data) - size + 1], leads)) if len(data) >= size else np.zeros(0, np.int64)
            value = np.zeros(len(spots), np.uint32)
            for k in range(size):
                value = value << np.uint32(8) | data[spots + k]
            spots = spots[np.isin(value, wanted)]
            if len(spots):
                out = data.copy() if out is data else out
                for k in range(size):
                    out[spots + k] = code
    return out


def hashed_words(texts: pa.Array, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, and where each text's words begin; white space of any script parts words.

    `plain` also drops all ASCII characters but letters and digits, and punctuation beyond ASCII, lets long dashes part
    words, and drops words of which nothing stays. A missing text has no word. A word's hash is a polynomial in its
    bytes, taken from running sums over the whole batch, of which one window is held at a time.
    """
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = ascii_parted(data, plain)
    code = np.arange(256)
    blank = (code == 32) | ((code >= 9) & (code <= 13)) | ((code >= 28) & (code <= 31))
    if plain:
        letter = (code >= 128) | ((code >= 97) & (code <= 122)) | ((code >= 48) & (code <= 57))
        kept = (letter | blank)[data]
        data, offsets = data[kept], np.concatenate([[0], np.cumsum(per_text(np.add, kept.view(np.int8), offsets, 0, np.int64))])
    inside = ~blank[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
    return mixed(polynomials(data, first, last) + (last - first).astype(np.uint64)), np.searchsorted(first, offsets)


@cache
def window_powers(base: int) -> np.ndarray:
    return powers(base, WINDOW)


def polynomials(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The polynomial in the bytes of every word, which lies from `first` to `last`; both ascend."""
    inverse = pow(BASE, -1, 1 << 64)
    up, down = window_powers(BASE), window_powers(inverse)
    before, back, behind = (np.zeros(len(first), np.uint64) for _ in range(3))
    total = np.zeros(1, np.uint64)
    for start in range(0, len(data), WINDOW):
        window = data[start : start + WINDOW]
        shift = np.uint64(pow(BASE, start, 1 << 64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((window.astype(np.uint64) + np.uint64(1)) * up[: len(window)])])
        begin = slice(*np.searchsorted(first, [start, start + len(window)]))
        end = slice(*np.searchsorted(last, [start, start + len(window)], "right"))
        before[begin] = total + sums[first[begin] - start] * shift
        back[begin] = down[first[begin] - start] * np.uint64(pow(inverse, start, 1 << 64))
        behind[end] = total + sums[last[end] - start] * shift
        total = total + sums[-1:] * shift
    return (behind - before) * back


def shingles_of(hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive words of each text, and where each text's begin.

    A text of fewer than n words, but at least one, has one shingle: all its words.
    """
    sizes = np.diff(starts)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    out_starts = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = starts[:-1][owner] + np.arange(out_starts[-1]) - out_starts[:-1][owner]
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    value = np.zeros(len(first), np.uint64)
    length = np.minimum(sizes[owner], n)
    for k in range(n):
        value = value * np.uint64(0x100000001B3) + np.where(k < length, padded[first + k], np.uint64(0)) * GOLD
    return mixed(value + length.astype(np.uint64)), out_starts


def per_text(ufunc, values: np.ndarray, starts: np.ndarray, empty, kind=None) -> np.ndarray:
    """Reduce the values of each text, as type `kind` if given; texts without values get `empty`."""
    out = np.full((len(starts) - 1, *values.shape[1:]), empty, kind or values.dtype)
    full = np.flatnonzero(np.diff(starts) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, starts[:-1][full], axis=0, dtype=kind)
    return out


def grams_of(strings: list[str], sizes: tuple[int, ...], buckets: int):
    """For every n-gram size: buckets of the hashed character n-grams, string by string, and where each string's begin.

    Each string counts as if a space stood on either side.
    """
    joined = np.frombuffer("".join(f" {s} " for s in strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(s) + 2 for s in strings), np.int64, len(strings))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(joined))  # characters from here to the end of the string
    value = np.zeros(len(joined), np.uint64)
    for n in range(1, max(sizes) + 1):
        value = value[: len(joined) - n + 1] * np.uint64(0x100000001B3) + (joined[n - 1 :] + np.uint64(1)) * GOLD
        if n in sizes:
            inside = left[: len(value)] >= n
            ids = (mixed(value[inside] + np.uint64(n)) >> np.uint64(40)) % np.uint64(buckets)
            yield ids.astype(np.int64), np.concatenate([[0], np.cumsum(np.maximum(lengths - n + 1, 0))])


def pieces(batch, column: str | None = None, most: int = AT_ONCE):
    """A batch (or an array of texts) in runs of rows with about `most` bytes of text, so that memory stays bounded."""
    texts = batch if column is None else batch.column(column)
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def given_back() -> None:
    """Return what a task has freed to the system: the worker stays, idle, beside those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_piece(texts: pa.Array, plan, kind: pa.DataType, most: int = AT_ONCE) -> pa.Array:
    """plan(texts) over the pieces of an array, put together again; then memory is given back."""
    out = pa.concat_arrays([pa.array([], kind), *(plan(piece) for piece in pieces(texts, most=most))])
    given_back()
    return out
