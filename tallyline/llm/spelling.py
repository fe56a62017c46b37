"""Spelling variants: words that differ by one letter, found over a reduced alphabet.

Letters are hashed to a few symbols. Two words one edit apart have reduced words at most one edit apart, so all reduced
words in the one-edit neighbourhood of a reduced word are looked up in the reduced vocabulary, and the words found are
compared as they are spelt. Each pair of reduced words is met from one side only: a word looks for the reduced words that
are shorter than its own, equal to it, or equal in length with a smaller symbol in one place; the others look for it.

The number of symbols follows the vocabulary (the least whose reduced words of the least length outnumber the words), so
a reduced word stands for few words at any size; it decides what is compared, never what is found. Neighbourhoods are
64-bit hashes of reduced words, formed by numpy from sums over the word; what collides is told apart by spelling.

Counting, the lookup and the comparison are Spark jobs: words are summed in each task before the shuffle, the lookup is
a join of two keyed tables that AQE splits where it is hot, and roots are found by doubling: a chain of forms grows at
least FACTOR-fold in occurrences at each step, so it is short and has no cycle. Every join is by shuffle and sort (see
beside): nothing that grows with the vocabulary passes the driver.

Defined results: a missing text has no word, a missing id counts as empty, rows that repeat an id or a text count each;
an empty table gives an empty one. A word's form is its near word of largest count, ties to the smallest in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of, settled
from tallyline.llm.words import BASE, powers

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Which runs lose a letter (those whose checksum this divides), what counts as a word, and how much more frequent a form is.
SLIP, LEAST_LENGTH, LEAST_COUNT, FACTOR = 199, 6, 5, 5
#: Letters whose neighbourhoods are formed at once.
AT_ONCE = 32_768


def slipped(run: Column, doc_id: Column) -> Column:
    """A run of letters, or one of SLIP runs without one letter; checksum of id and run decide which."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % SLIP == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of all texts with their occurrences."""
    runs = columns_of(docs, doc_id="bigint", text="string").select(
        "doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    # A run gets no longer, so a short one is no word.
    words = runs.filter(F.char_length("run") >= LEAST_LENGTH).select(slipped(F.col("run"), F.col("doc_id")).alias("word"))
    return words.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def symbols_for(count: int, length: int = LEAST_LENGTH) -> int:
    """The least number of symbols whose words of the given length are as many as the vocabulary; at least 2."""
    symbols = 2
    while symbols**length < count:
        symbols += 1
    return symbols


def reduced(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the places of the words of that length, and a matrix of their letters' symbols."""
    sizes = np.fromiter((len(w) for w in words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letters = ((codes * np.uint64(BASE)) >> np.uint64(33)) % np.uint64(symbols)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, letters[starts[places][:, None] + np.arange(size)]


def summed(letters: np.ndarray) -> np.ndarray:
    """Running sums of (symbol + 1) * BASE**place along each word, beginning with 0; the last is the key of the reduced word."""
    sums = np.cumsum((letters + np.uint64(1)) * powers(BASE, letters.shape[1]), axis=1, dtype=np.uint64)
    return np.concatenate([np.zeros((len(letters), 1), np.uint64), sums], axis=1)


def neighbourhood(letters: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of each reduced word itself, without one letter, and with a smaller symbol in one place; none twice.

    The edits of a block of places at a time, so that a very long word takes no more room than its running sums.
    """
    count, length = letters.shape
    sums, power, back = summed(letters), powers(BASE, length), np.uint64(pow(BASE, -1, 1 << 64))
    own = sums[:, -1:]
    yield np.arange(count), own[:, 0]
    width = max(1, AT_ONCE // count)
    for at in range(0, length, width):
        block = letters[:, at : at + width]
        # Of a run of equal symbols, any one taken away leaves the same word.
        last = np.ones(block.shape, bool)
        after = letters[:, at + 1 : at + width + 1]
        last[:, : after.shape[1]] = block[:, : after.shape[1]] != after
        begun = sums[:, at : at + block.shape[1] + 1]
        shorter = begun[:, :-1] + (own - begun[:, 1:]) * back
        yield np.nonzero(last)[0], shorter[last]
        for symbol in range(symbols):
            lower = block > symbol
            changed = own - (block - np.uint64(symbol)) * power[at : at + width]
            yield np.nonzero(lower)[0], changed[lower]


def by_letters(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of words of AT_ONCE letters altogether, or of one longer word."""
    sizes = np.cumsum(np.asarray(pc.utf8_length(batch.column("word")), np.int64))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + AT_ONCE, "right")))
        yield batch.slice(first, last - first)
        first = last


def lookups(symbols: int):
    """Of batches (id, word): key, id and whether the key is the word's own, for each key of its neighbourhood."""

    def plan(batches):
        for whole in batches:
            for batch in by_letters(whole):
                ids = np.asarray(batch.column("id"))
                for places, letters in reduced(batch.column("word").to_pylist(), symbols):
                    for turn, (rows, keys) in enumerate(neighbourhood(letters, symbols)):
                        if len(rows):
                            columns = [pa.array(keys.view(np.int64)), pa.array(ids[places[rows]]), pa.array(np.full(len(rows), turn == 0))]
                            yield pa.RecordBatch.from_arrays(columns, ["key", "id", "own"])

    return plan


def own_keys(symbols: int):
    """Of batches (id, word, n): the key of the reduced word, and the batch's columns."""

    def plan(batches):
        for whole in batches:
            for batch in by_letters(whole):
                for places, letters in reduced(batch.column("word").to_pylist(), symbols):
                    found = batch.take(pa.array(places))
                    yield pa.RecordBatch.from_arrays([pa.array(summed(letters)[:, -1].view(np.int64)), *found.columns], ["entry", "other_id", "other", "other_n"])

    return plan


def beside(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """A join by shuffle and sort, never a broadcast, which the driver would have to hold.

    Spark sizes a table by its compressed files, and a Python step as one row for each row read: the keys of all
    neighbourhoods, dozens for each word, count as less than the file of the words.
    """
    return left.hint("merge").join(right, on, how)


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, other, other_n) for every two words (columns id, word, n) that are one letter apart, in both directions.

    Lookups carry a word's number, not its spelling, so a word of any length costs 16 bytes for each of its neighbours.
    """
    symbols = symbols or symbols_for(words.count())
    looked = words.select("id", "word").mapInArrow(lookups(symbols), "key bigint, id bigint, own boolean")
    entries = words.select("id", "word", "n").mapInArrow(own_keys(symbols), "entry bigint, other_id bigint, other string, other_n bigint")
    met = beside(looked, entries, F.col("key") == F.col("entry")).filter(F.when(F.col("own"), F.col("id") < F.col("other_id")).otherwise(True))
    spelt = beside(met.select("id", "other", "other_n"), words.select("id", "word", "n"), "id")
    pairs = spelt.filter(F.levenshtein("word", "other", 1) == 1)
    back = F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.select(F.explode(F.array(F.struct("word", "n", "other", "other_n"), back)).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead to. Each round doubles how far a row has followed them."""
    now = settled(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")), "forms")
    while now.filter(~F.col("done")).limit(1).count():
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = settled(beside(now, ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNull().alias("done")), "forms")
    return now.select("word", "root")


def variants(docs: DataFrame, symbols: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = settled(vocabulary(docs).withColumn("id", F.monotonically_increasing_id()), "words")
    nothing = F.lit(None)
    rows = words.select("word", "n", nothing.cast("string").alias("other"), nothing.cast("bigint").alias("other_n")).unionByName(near_pairs(words, symbols))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word"))))
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= FACTOR * F.col("n")
    judged = settled(found.select(
        "word", F.when(is_form, F.col("best.word")).alias("form"), "n", "n_near", F.when(is_form, -F.col("best.less")).alias("form_n")), "judged")
    ends = roots(judged.filter("form IS NOT NULL")).withColumnRenamed("word", "of")
    return beside(judged, ends, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
