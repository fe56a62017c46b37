"""Toxicity: a small convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word, its prefixes and its suffixes. Filters of width 1, 2
and 3 run over all words of a text, each keeps its maximum over the text, and a linear layer gives the logit.
Training takes a bounded sample of the labelled rows; the scoring runs on Arrow batches of whole texts. The
threshold is calibrated for each language on all labelled rows the weights haven't seen, counted on Spark and weighted
to the shares the labels have among all labelled rows; the language of a text is itself predicted from the text. A
language with fewer than LEAST_ROWS such rows of either label takes the threshold of all languages. A score is the logit moved so that the language's threshold becomes `CUT`.

Defined results: a missing text counts as empty, an empty text gets the score of "no word at all"; without labels
of both kinds every score is 0. Rows are scored one by one, so repeated rows and ids change nothing. Of several
labels for one id the largest counts; labels for ids without a document, and null labels, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import language
from tallyline.llm.frames import bounded_sample, class_sizes, columns_of
from tallyline.llm.words import GOLD, by_piece, mixed, words_of

#: Labelled rows to learn from, for each of the two labels.
ROWS_PER_LABEL = 2_000
CUT = 0.7
#: Rows of each label that a language needs for a threshold of its own.
LEAST_ROWS = 15
#: Logits are counted in bins of 1 / BINS around 0, of 1 / BINS of their size far from it.
BINS = 50
#: So many labelled ids are sent to every task, to score only their rows; of more, all rows are scored.
SENT_IDS = 1_000_000
BUCKETS, WIDTH, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4)
EPOCHS, BATCH, RATE = 5, 64, 0.05
#: A small sample is gone over more often, until so many batches are done.
LEAST_BATCHES = 300
#: Words per step of the forward pass; a longer text is a step of its own.
STEP = 20_000


def features(words) -> np.ndarray:
    """Buckets of every distinct word: the word itself, its prefixes, its suffixes."""
    vocabulary = words.vocabulary
    letters = np.frombuffer("".join(vocabulary).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    letters = np.concatenate([letters, np.zeros(1, np.uint64)])
    out = [np.zeros(len(vocabulary), np.uint64)]
    whole = np.zeros(len(vocabulary), np.uint64)
    for k in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > k)
        whole[live] = whole[live] * np.uint64(0x100000001B3) + (letters[starts[live] + k] + np.uint64(1)) * GOLD
    out = [mixed(whole)]
    for tag, size in [*((1, p) for p in PREFIXES), *((2, s) for s in SUFFIXES)]:
        value = np.zeros(len(vocabulary), np.uint64)
        for k in range(size):
            at = starts + k if tag == 1 else ends - 1 - k
            value = value * np.uint64(0x100000001B3) + np.where(k < lengths, letters[np.where(k < lengths, at, -1)] + np.uint64(1), np.uint64(0)) * GOLD
        out.append(mixed(value + np.uint64(tag * 16 + size)))
    return (np.stack(out, axis=1) >> np.uint64(40)).astype(np.int64) % BUCKETS


def steps(starts: np.ndarray):
    """Runs of whole texts with about STEP words each."""
    first = 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + STEP, "right")) - 1)
        yield first, last
        first = last


def pooled(by_word: list[np.ndarray], codes: np.ndarray, starts: np.ndarray, bias: np.ndarray, places: bool = False):
    """Maximum of every filter over every text, at least 0; optionally also the word where it lies (-1: none)."""
    n, texts = len(codes), len(starts) - 1
    out = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    where = np.full(out.shape, -1, np.int64) if places else None
    full = np.flatnonzero(np.diff(starts) > 0)
    if not len(full):
        return out, where
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)  # words from here to the end of the text
    table = 0
    for i, width in enumerate(WIDTHS):
        part = slice(i * FILTERS, (i + 1) * FILTERS)
        value = by_word[table][codes]
        for k in range(1, width):
            if n > k:
                value[:-k] += np.where((left[:-k] > k)[:, None], by_word[table + k][codes[k:]], np.float32(0))
        table += width
        value += bias[part]
        top = np.maximum.reduceat(value, starts[:-1][full], axis=0)
        out[full, part] = np.maximum(top, 0)
        if places:
            for t, row in zip(full, top, strict=True):
                where[t, part] = np.where(row > 0, starts[t] + value[starts[t] : starts[t + 1]].argmax(axis=0), -1)
    return out, where


def projected(vectors: np.ndarray, kernels: list[np.ndarray]) -> list[np.ndarray]:
    return [(vectors @ kernel).astype(np.float32) for kernel in kernels]


def logits(words, model: dict) -> np.ndarray:
    """The logit of every text of a batch, before calibration."""
    out = np.zeros(len(words.starts) - 1)
    by_word = projected(model["embedding"][features(words)].sum(axis=1), model["kernels"]) if words.vocabulary else [np.zeros((1, FILTERS), np.float32)] * sum(WIDTHS)
    for first, last in steps(words.starts):
        span = words.starts[first : last + 1]
        top, _ = pooled(by_word, words.codes[span[0] : span[-1]], span - span[0], model["filter_bias"])
        out[first:last] = top @ model["weights"] + model["bias"]
    return out


def trained(texts: list[str | None], labels: np.ndarray, seed: int = 7) -> dict:
    """Weights fitted by Adagrad on the weighted logistic loss."""
    draw = np.random.default_rng(seed)
    model = {
        "embedding": draw.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32),
        "kernels": [draw.normal(0, 0.3, (WIDTH, FILTERS)).astype(np.float32) for _ in range(sum(WIDTHS))],
        "filter_bias": np.zeros(len(WIDTHS) * FILTERS, np.float32),
        "weights": draw.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), "bias": 0.0,
    }
    pace = {k: [np.full(x.shape, 1e-3, np.float32) for x in model[k]] if k == "kernels" else np.full(np.shape(model[k]), 1e-3, np.float32) for k in model}
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first_table = np.cumsum([0, *WIDTHS])
    for _ in range(max(EPOCHS, -(-LEAST_BATCHES * BATCH // len(texts)))):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            words = words_of(pa.array([texts[i] for i in chosen], pa.string()))
            ids = features(words) if words.vocabulary else np.zeros((1, 1), np.int64)
            vectors = model["embedding"][ids].sum(axis=1)
            top, where = pooled(projected(vectors, model["kernels"]), words.codes, words.starts, model["filter_bias"], places=True)
            wrong = (1 / (1 + np.exp(-(top @ model["weights"] + model["bias"]))) - labels[chosen]) * weight[chosen] / len(chosen)
            wrong = wrong.astype(np.float32)
            slope = wrong[:, None] * model["weights"][None, :] * (where >= 0)
            change = {"weights": wrong @ top, "filter_bias": slope.sum(axis=0)}
            back_words, back = [], []
            for i, width in enumerate(WIDTHS):
                t, f = np.nonzero(where[:, i * FILTERS : (i + 1) * FILTERS] >= 0)
                spot, amount = where[t, i * FILTERS + f], slope[t, i * FILTERS + f]
                for k in range(width):
                    live = spot + k < words.starts[t + 1]
                    code = words.codes[spot[live] + k]
                    kernel = model["kernels"][first_table[i] + k]
                    grad = np.zeros_like(kernel)
                    np.add.at(grad.T, f[live], amount[live, None] * vectors[code])
                    back_words.append(code)
                    back.append(amount[live, None] * kernel.T[f[live]])
                    change["kernels", first_table[i] + k] = grad
            if back_words and sum(map(len, back_words)):
                codes, place = np.unique(np.concatenate(back_words), return_inverse=True)
                by_code = np.zeros((len(codes), WIDTH), np.float32)
                np.add.at(by_code, place, np.concatenate(back))
                rows, place = np.unique(ids[codes], return_inverse=True)
                grad = np.zeros((len(rows), WIDTH), np.float32)
                np.add.at(grad, place.reshape(len(codes), -1), by_code[:, None, :])
                pace["embedding"][rows] += grad**2
                model["embedding"][rows] -= RATE * grad / np.sqrt(pace["embedding"][rows])
            for key, grad in change.items():
                kept, held = (model["kernels"], pace["kernels"]) if isinstance(key, tuple) else (model, pace)
                key = key[1] if isinstance(key, tuple) else key
                held[key] += grad**2
                kept[key] -= RATE * grad / np.sqrt(held[key])
            pace["bias"] += wrong.sum() ** 2
            model["bias"] -= float(RATE * wrong.sum() / np.sqrt(pace["bias"]))
    return model


def best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The threshold with the largest F1 of weighted rows, in the middle between the scores on either side of it."""
    order = np.argsort(-scores, kind="stable")
    weights = np.ones(len(scores)) if weights is None else weights[order]
    scores, hits = scores[order], np.cumsum(labels[order] * weights)
    f1 = 2 * hits / (np.cumsum(weights) + hits[-1])
    f1[np.append(scores[1:] == scores[:-1], False)] = -1  # ties are not parted
    at = int(f1.argmax())
    return float((scores[at] + scores[at + 1]) / 2) if at + 1 < len(scores) else float(scores[at] - 1)


def tongues(words, model: dict) -> np.ndarray:
    """The place of every text's predicted language; without languages, 0."""
    if model["tongue"] is None or len(words.starts) < 2:
        return np.zeros(len(words.starts) - 1, np.int64)
    log_prob, sizes, prior = model["tongue"]
    return (language.log_scores(words, log_prob, sizes) + prior).argmax(axis=1)


def counted(docs: DataFrame, known: DataFrame, used: DataFrame, model: dict) -> list:
    """Rows (toxic, used, tongue, bin, n): how many labelled rows of docs have which label, language and logit."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("tongue int, bin int")
    def place(texts: pa.Array) -> pa.Array:
        def of_piece(piece):
            words = words_of(piece)
            bins = np.floor(np.arcsinh(logits(words, sent.value)) * BINS)
            return pa.StructArray.from_arrays([pa.array(tongues(words, sent.value), pa.int32()), pa.array(bins, pa.int32(), safe=False)], names=["tongue", "bin"])

        return by_piece(texts, of_piece, pa.struct([("tongue", pa.int32()), ("bin", pa.int32())]))

    rows = columns_of(docs, doc_id="bigint", text="string").filter("doc_id IS NOT NULL")
    if known.count() <= SENT_IDS:
        rows = rows.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    placed = rows.select("doc_id", place(F.col("text")).alias("at")).select("doc_id", "at.tongue", "at.bin")
    seen = used.select(F.col("doc_id").alias("used_id"))
    flagged = known.join(F.broadcast(seen), F.col("doc_id") == F.col("used_id"), "left").select("doc_id", "toxic", F.col("used_id").isNotNull().alias("used"))
    return placed.join(flagged, "doc_id").groupBy("toxic", "used", "tongue", "bin").agg(F.count("*").alias("n")).collect()  # as many as there are bins


def cuts_of(found: list, languages: int) -> list[float]:
    """The threshold of every language from the rows of `counted`."""
    toxic, used, tongue, place, n = (np.array(c) for c in zip(*found, strict=True))
    all_rows = [n[toxic == k].sum() for k in (0, 1)]
    free = ~used.astype(bool)
    if not all(n[free & (toxic == k)].sum() for k in (0, 1)):
        free[:] = True  # too few labelled rows to keep some from the weights
    toxic, tongue, place, n = toxic[free], tongue[free], place[free], n[free]
    weight = n * np.array([all_rows[k] / n[toxic == k].sum() for k in (0, 1)])[toxic]
    score = np.sinh((place + 0.5) / BINS)
    common = best_cut(score, toxic, weight)
    own = [tongue == i for i in range(languages)]
    enough = [min(n[mine & (toxic == k)].sum() for k in (0, 1)) >= LEAST_ROWS for mine in own]
    return [best_cut(score[mine], toxic[mine], weight[mine]) if e else common for mine, e in zip(own, enough, strict=True)]


def fit(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> dict | None:
    """Learn from documents (doc_id, text, lang) and labels (doc_id, toxic): about `rows_per_label` rows of each label.

    Four of five sampled ids fit the weights; all labelled rows of other ids fit the thresholds. None if either label is missing.
    """
    known = columns_of(labels, doc_id="bigint", toxic="int").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    sample = bounded_sample(known, "toxic", class_sizes(known, "toxic", 2), F.col("doc_id"), rows_per_label)
    sample = sample.withColumn("used", F.pmod(F.xxhash64("doc_id", F.lit("weights")), F.lit(5)) != 4)
    rows = columns_of(docs, doc_id="bigint", text="string", lang="string").join(F.broadcast(sample), "doc_id")
    found = rows.select("doc_id", "text", "toxic", "used", "lang").orderBy("doc_id", "text").collect()  # a bounded number of rows
    toxic = np.array([int(r["toxic"] > 0) for r in found], float)
    if not 0 < toxic.sum() < len(toxic):
        return None
    kept = np.array([r["used"] for r in found])
    if not 0 < toxic[kept].sum() < kept.sum():
        kept[:] = True
        sample = sample.withColumn("used", F.lit(True))
    texts = [r["text"] for r in found]
    model = trained([t for t, k in zip(texts, kept, strict=True) if k], toxic[kept])
    tongue = language.fit(docs.sparkSession.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in found], "doc_id bigint, text string, lang string")) if any(r["lang"] for r in found) else None
    model["tongue"] = (tongue.log_prob, tongue.sizes, tongue.log_prior) if tongue and tongue.languages else None
    model["cuts"] = cuts_of(counted(docs, known, sample.filter("used"), model), len(tongue.languages) if model["tongue"] else 1)
    return model


def scored(texts: pa.Array, model: dict) -> pa.Array:
    words = words_of(texts)
    cuts = np.array(model["cuts"])[tongues(words, model)]
    return pa.array(1 / (1 + np.exp(-np.clip(logits(words, model) - cuts + np.log(CUT / (1 - CUT)), -500, 500))), pa.float64())


def score(df: DataFrame, model: dict | None, text: Column) -> Column:
    """The score of a text as a column."""
    if model is None:
        return F.lit(0.0)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return by_piece(texts, lambda piece: scored(piece, sent.value), pa.float64())

    return toxicity(text)
