"""Language identification: multinomial naive Bayes over hashed character n-grams.

`fit` counts the n-grams of a bounded sample of the labelled rows on the executors; the log-probability matrix
(buckets x languages) goes to every task once, and `predict` scores whole Arrow batches in numpy: the n-grams of
the distinct words of a batch are looked up once, and a text's score is the sum over its words.

Defined results: a text that is null or holds no letter is `und` with score 0; so is every text if nothing was
learned. Ties go to the language that comes first in the alphabet. Words are lower case; n-grams don't cross words,
but see where a word begins and ends. Rows are scored one by one: repeated rows and repeated ids change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import BROADCAST_BYTES, bounded_sample, class_sizes, columns_of
from tallyline.llm.words import by_piece, given_back, grams_of, per_text, pieces, words_of

UNDETERMINED = "und"
FOUND = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
SIZES = (1, 2, 3)
BUCKETS, LEAST_BUCKETS = 1 << 15, 1 << 8
#: Labelled rows to learn from, for each language.
ROWS_PER_LANGUAGE = 10_000
#: Distinct values of lang that are learned at most; their counts pass the driver.
MOST_LANGUAGES = 100_000


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages
    sizes: tuple[int, ...]


def gram_counts(batches, sizes, buckets):
    """For the texts of one task: how often each bucket occurs in each language."""
    sums: dict[str, np.ndarray] = {}
    for batch in (piece for batch in batches for piece in pieces(batch, "text")):
        coded = batch.column("lang").dictionary_encode()
        names, of_text = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64)
        words = words_of(batch.column("text"))
        if not len(words.codes):
            continue
        of_word = np.repeat(of_text, np.diff(words.starts))
        order = np.argsort(of_word, kind="stable")
        edges = np.searchsorted(of_word[order], np.arange(len(names) + 1))
        times = {x: np.unique(words.codes[order[a:z]], return_counts=True) for x, a, z in zip(names, edges[:-1], edges[1:], strict=True) if z > a}
        for ids, starts in grams_of(words.vocabulary, sizes, buckets):
            for language, (mine, count) in times.items():
                lengths = starts[mine + 1] - starts[mine]
                ends = np.cumsum(lengths)
                spots = np.repeat(starts[mine] - ends + lengths, lengths) + np.arange(ends[-1])
                sums[language] = sums.get(language, 0) + np.bincount(ids[spots], weights=np.repeat(count, lengths), minlength=buckets)
    for language, found in sums.items():
        full = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(found[full].astype(np.int64))],
            names=["lang", "bucket", "n"])
    given_back()


def fit(rows: DataFrame, sizes: tuple[int, ...] = SIZES, buckets: int = BUCKETS, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from the rows (doc_id, text, lang) whose text and lang are not null.

    At most about `rows_per_language` rows of each language are counted, chosen by the hash of doc_id; the priors
    count all rows. Laplace smoothing with 0.5. The matrix that is sent to the tasks stays below BROADCAST_BYTES: more
    languages than fit (256 at 32,768 buckets) share fewer buckets, halved until they do.
    """
    labelled = columns_of(rows, doc_id="string", text="string", lang="string").filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes_by = class_sizes(labelled, "lang", MOST_LANGUAGES)
    languages = sorted(sizes_by)
    while buckets * len(languages) * 4 > BROADCAST_BYTES and buckets > LEAST_BUCKETS:
        buckets //= 2
    place = {x: k for k, x in enumerate(languages)}
    sample = bounded_sample(labelled, "lang", sizes_by, F.col("doc_id"), rows_per_language).select("text", "lang")
    grams = tuple(sizes)
    found = (
        sample.mapInArrow(lambda batches: gram_counts(batches, grams, buckets), "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))  # at most `buckets` cells a language
    ).collect()
    counts = np.zeros((buckets, len(languages)))
    for row in found:
        cells = np.array([(c["bucket"], c["n"]) for c in row["cells"]])
        counts[cells[:, 0], place[row["lang"]]] = cells[:, 1]
    smooth = counts + 0.5
    log_prob = np.log(smooth / smooth.sum(axis=0)) if languages else counts
    prior = np.array([sizes_by[x] for x in languages], float)
    return Model(languages, np.log(prior / prior.sum()) if languages else prior, log_prob.astype(np.float32), grams)


def log_scores(words, log_prob: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """Log-likelihood of every text under every class, one class at a time."""
    grams = list(grams_of(words.vocabulary, sizes, len(log_prob))) if words.vocabulary else []
    out = np.zeros((len(words.starts) - 1, log_prob.shape[1]))
    for c in range(log_prob.shape[1]):
        column, by_word = np.ascontiguousarray(log_prob[:, c]), np.zeros(len(words.vocabulary))
        for ids, starts in grams:
            by_word += per_text(np.add, column[ids], starts, np.float32(0))
        out[:, c] = per_text(np.add, by_word[words.codes], words.starts, 0.0)
    return out


def predicted(texts: pa.Array, model: dict) -> pa.StructArray:
    """The language of every text of a batch and its posterior probability."""
    count = len(texts)
    lettered = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
    names, best, score = np.array([*model["languages"], UNDETERMINED], object), np.full(count, len(model["languages"])), np.zeros(count)
    if model["languages"] and count:
        scores = log_scores(words_of(texts), model["log_prob"], model["sizes"]) + model["log_prior"]
        top = scores.argmax(axis=1)
        chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        best, score = np.where(lettered, top, best), np.where(lettered, chance, 0.0)
    return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])


def predictor(df: DataFrame, model: Model):
    """A column function: text -> struct(lang_pred, score)."""
    sent = df.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("lang_pred string, score double")
    def language(texts: pa.Array) -> pa.Array:
        return by_piece(texts, lambda piece: predicted(piece, sent.value), FOUND)

    return language


def predict(df: DataFrame, model: Model, text: Column, *keep: Column) -> DataFrame:
    """The kept columns with lang_pred and score."""
    return df.select(*keep, predictor(df, model)(text).alias("found")).select("*", "found.lang_pred", "found.score").drop("found")
