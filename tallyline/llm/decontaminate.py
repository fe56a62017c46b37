"""Benchmark decontamination: pigeonhole pieces find places, Myers' bit-parallel distance decides.

A test item of m words may occur with up to k = floor(rate * m) word edits (insert, delete, replace). It is cut into
k + 1 pieces of nearly equal length, one of which must occur unchanged. Rolling hashes of whole texts are looked up in
the pieces' hashes; around every hit the edit distance of the item to the best part of the text is computed.

Words are what stands between white space, in lower case, without ASCII characters other than letters and digits;
words of which nothing stays don't count. Defined results: texts and items that are null or without words match nothing. Repeated
items count once for each item_id; documents are looked at row by row, whatever their ids.

The items go to every task while all of them weigh at most BLOCK_CHARS; a larger table is dealt into blocks by hash,
and the documents are gone over once for each block, with the result written in between.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of, fresh, settled, total
from tallyline.llm.words import BASE, by_piece, hashed_words, powers

RATE = 0.15
BLOCK_CHARS = 8 << 20
FOUND_SQL = "array<struct<item_id:bigint,distance:int,end_word:bigint>>"
FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end_word", pa.int64())]))
FILTER_BITS = 20


def cut(length: int, pieces: int) -> list[tuple[int, int]]:
    """(start, end) of nearly equal pieces."""
    edges = [length * k // pieces for k in range(pieces + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def index(items: list[tuple[int | None, str | None]], rate: float = RATE) -> dict:
    """The items as word hashes, and by length of piece: sorted hashes and what they stand for."""
    hashes, starts = hashed_words(pa.array([t for _, t in items], pa.string()), plain=True)
    known, pieces = [], {}
    for (name, _), a, z in zip(items, starts[:-1], starts[1:], strict=True):
        if z == a:
            continue
        mine = hashes[a:z]
        budget = int(rate * len(mine))
        for first, last in cut(len(mine), budget + 1):
            value = int((mine[first:last] * powers(BASE, last - first)).sum())
            pieces.setdefault(last - first, []).append((value, len(known), first))
        known.append((name, mine, budget))
    tables = {}
    for length, found in pieces.items():
        found.sort()
        value = np.array([f[0] for f in found], np.uint64)
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[value >> np.uint64(64 - FILTER_BITS)] = True
        tables[length] = (value, np.array([f[1:] for f in found]), seen)
    return {"items": known, "tables": tables}


def distance(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least number of word edits between the pattern and any part of the text, and where that part ends."""
    bits: dict[int, int] = {}
    for k, word in enumerate(pattern.tolist()):
        bits[word] = bits.get(word, 0) | 1 << k
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    plus, minus, score = full, 0, len(pattern)
    best, end = score, 0
    for k, word in enumerate(text.tolist(), 1):
        equal = bits.get(word, 0)
        down = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, low = minus | (full & ~(across | plus)), plus & across
        score += bool(up & top) - bool(low & top)
        up, low = up << 1, low << 1
        plus = (low | ~(down | up)) & full
        minus = up & down & full
        if score < best:
            best, end = score, k
    return best, end


def found_in(texts: pa.Array, known: dict) -> pa.Array:
    """The items that occur in each text, each with its least distance."""
    hashes, starts = hashed_words(texts, plain=True)
    n = len(hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(BASE, n))])
    back = powers(pow(BASE, -1, 1 << 64), n)
    end_of = np.repeat(starts[1:], np.diff(starts))
    places: dict[tuple[int, int], set[int]] = {}
    for length, (value, stands, seen) in known["tables"].items():
        if length > n:
            continue
        rolled = (sums[length:] - sums[:-length]) * back[: n - length + 1]
        spots = np.flatnonzero(seen[rolled >> np.uint64(64 - FILTER_BITS)])
        spots = spots[spots + length <= end_of[spots]]
        low, high = np.searchsorted(value, rolled[spots]), np.searchsorted(value, rolled[spots], "right")
        for spot, a, z in zip(spots[high > low], low[high > low], high[high > low], strict=True):
            text = int(np.searchsorted(starts, spot, "right")) - 1
            for item, offset in stands[a:z].tolist():
                places.setdefault((text, item), set()).add(int(spot) - offset)
    out: list[dict[int | None, tuple]] = [{} for _ in range(len(texts))]
    for (text, item), begins in sorted(places.items()):
        name, mine, budget = known["items"][item]
        for begin in sorted(begins):
            first, last = max(starts[text], begin - budget), min(starts[text + 1], begin + len(mine) + budget)
            edits, end = distance(mine, hashes[first:last])
            if edits <= budget:
                hit = (edits, int(first - starts[text] + end))
                out[text][name] = min(out[text].get(name, hit), hit)
    rows = [[{"item_id": name, "distance": d, "end_word": e} for name, (d, e) in sorted(hits.items(), key=lambda x: (x[0] is None, x[0]))] for hits in out]
    return pa.array(rows, FOUND)


def finder(sent):
    """A column function: text -> the items of a broadcast index found in it."""

    @F.arrow_udf(FOUND_SQL)
    def find(texts: pa.Array) -> pa.Array:
        return by_piece(texts, lambda piece: found_in(piece, sent.value), FOUND)

    return find


def finders(items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS):
    """For each block of items a column function: text -> the items found."""
    named = columns_of(items, item_id="bigint", text="string").filter("text IS NOT NULL").distinct()
    weight, = total(named, F.sum(F.length("text") + F.lit(100)))
    blocks = max(1, -(-weight // block_chars))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = [(r[0], r[1]) for r in named.filter(place == block).orderBy("item_id", "text").collect()]
        yield finder(items.sparkSession.sparkContext.broadcast(index(rows, rate)))


def matches(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and the array `found` (item_id, distance, end_word) for every row of docs."""
    rows = columns_of(docs, doc_id="bigint", text="string").withColumn("found", F.expr(f"CAST(array() AS {FOUND_SQL})"))
    for place, find in enumerate(finders(items, rate, block_chars)):
        rows = (settled(rows) if place else rows).withColumn("found", F.concat("found", find(F.col("text"))))
    return rows.select("doc_id", "found")


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs in which no item occurs."""
    for place, find in enumerate(finders(items, rate, block_chars)):
        hits, = fresh(docs, "hits")
        docs = (settled(docs) if place else docs).withColumn(hits, F.size(find(F.col("text").cast("string")))).filter(F.col(hits) == 0).drop(hits)
    return docs


def verdict(found: Column) -> dict[str, Column]:
    return {
        "contaminated": F.size(found) > 0, "n_items": F.size(found), "items": F.transform(found, lambda x: x["item_id"]),
        "least_distance": F.array_min(F.transform(found, lambda x: x["distance"])),
    }
