"""Token files: every text encoded, in ascending doc_id order, in shards of one wavelet matrix each.

The documents are dealt by ranges of doc_id and row number; each task encodes its range in order and closes a shard when it holds
about SHARD_TOKENS tokens. Shards are written by Spark (one row each: where it stands, and its blob), so a lost
executor's work is repeated and committed once.

Defined results: a missing text counts as empty, an empty one has the end token only. A missing doc_id sorts first;
rows that repeat an id are kept, in the order in which they are read. An empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of
from tallyline.llm.wavelet import WaveletMatrix, packed
from tallyline.llm.words import given_back, pieces

END = 2
SHARD_TOKENS = 1 << 20
#: Distinct pieces whose ids a Python worker remembers, about 50 bytes each, for as long as it lives: an executor keeps
#: more workers than it has cores, and each of them remembers.
REMEMBERED = 1_000_000
#: Bytes of text encoded at once.
AT_ONCE = 3 << 20
SHARDS_SQL = "part int, shard int, n_docs bigint, n_tokens bigint, blob binary"
READ_SQL = "part int, shard int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


def run_of(first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `first` and, laid end to end, end at `ends`."""
    sizes = np.diff(ends, prepend=0)
    return np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of whole texts, exactly as the tokenizer gives them, from the remembered ids of their pieces.

    Byte-level pre-tokenizers begin a new unit at a space between two visible characters, and a line break between
    two of them is a unit of its own, so a text may be cut there: what the tokenizer says of the pieces, those behind
    a space with the space before them, is what it says of the text. A text in which white space touches white space
    is cut between visible characters only. A batch is cut and its distinct pieces are found by Arrow; a new piece
    that is a word, perhaps with a stop behind it, goes to the tokenizer's model at once, any other through the whole
    tokenizer.
    """

    LOOSE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"
    JOINT = re.compile(r"(?<=\S) (?=\S)")
    WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+([.,]?)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        shape = json.loads(self.tokenizer.to_str())
        steps = shape["pre_tokenizer"] or {}
        # Words may skip the steps before the model only where those are known to keep them whole.
        self.direct = shape["normalizer"] is None and shape["model"]["type"] == "BPE" and steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
        self.stops = {stop: self.tokenizer.encode(stop, add_special_tokens=False).ids for stop in ".,"}
        # Remembered pieces: their digests in two halves, ordered by the first, and where the ids of each begin and end.
        self.low = self.high = np.zeros(0, np.uint64)
        self.first = self.last = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        # Which of them were asked for again since the memory was last full.
        self.again = np.zeros(0, bool)

    def remembered(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where each digest is remembered; -1 for those that aren't."""
        if not len(self.low):
            return np.full(len(low), -1)
        at = np.minimum(np.searchsorted(self.low, low), len(self.low) - 1)
        return np.where((self.low[at] == low) & (self.high[at] == high), at, -1)

    def learn(self, low: np.ndarray, high: np.ndarray, ends: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Remember new pieces; where that would be too many, of the others those stay that were asked for again, if they leave half of the room, or else now (places in `wanted`)."""
        if len(self.low) + len(low) > REMEMBERED:
            kept = np.flatnonzero(self.again)
            if len(kept) > REMEMBERED // 2:
                kept = np.unique(wanted[wanted >= 0])
            self.again = np.zeros(len(kept), bool)
            sizes = np.cumsum(self.last[kept] - self.first[kept])
            self.ids = self.ids[run_of(self.first[kept], sizes)]
            self.low, self.high, self.first, self.last = self.low[kept], self.high[kept], np.append(0, sizes[:-1])[: len(kept)], sizes
        begins = np.append(0, ends[:-1])[: len(ends)] + len(self.ids)
        order = np.argsort(np.concatenate([self.low, low]), kind="stable")
        self.low, self.high, self.first, self.last = (
            np.concatenate(pair)[order] for pair in ((self.low, low), (self.high, high), (self.first, begins), (self.last, ends + len(self.ids))))
        self.again = np.concatenate([self.again, np.zeros(len(low), bool)])[order]
        self.ids = np.concatenate([self.ids, ids])

    @staticmethod
    def digests(pieces: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        lead = " " if spaced else ""
        both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(lead + p) for p in pieces]), np.uint64).reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()

    def tokenized(self, pieces: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in a row, and where those of each end; `spaced` pieces have a space before them."""
        tokenize, fullmatch = self.model.tokenize, self.WORD.fullmatch
        found: list = [None] * len(pieces)
        words, stopped, rest = [], [], []
        for k, piece in enumerate(pieces):
            word = fullmatch(piece) if self.direct else None
            (rest if word is None else stopped if word[1] else words).append(k)
        lead, letters = "Ġ" if spaced else "", self.letters
        bases: dict[str, list[int]] = {}
        for k in words:
            base = pieces[k]
            form = base if base.isascii() else base.encode().decode("latin1").translate(letters)
            bases[base] = found[k] = [t.id for t in tokenize(lead + form)]
        # A word with a stop behind it may be remembered without.
        asked = list({pieces[k][:-1] for k in stopped} - bases.keys())
        for base, at in zip(asked, self.remembered(*self.digests(asked, spaced)).tolist(), strict=True):
            if at >= 0:
                bases[base] = self.ids[self.first[at] : self.last[at]].tolist()
            else:
                form = base if base.isascii() else base.encode().decode("latin1").translate(letters)
                bases[base] = [t.id for t in tokenize(lead + form)]
        for k in stopped:
            found[k] = bases[pieces[k][:-1]] + self.stops[pieces[k][-1]]
        for at in range(0, len(rest), 10_000):
            some = rest[at : at + 10_000]
            texts = [" " + pieces[k] if spaced else pieces[k] for k in some]
            for k, encoding in zip(some, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                found[k] = encoding.ids
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        return ends, np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1]) if len(ends) else 0)

    def ids_of(self, pieces: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in a row, and where those of each end, as far as possible from memory."""
        low, high = self.digests(pieces, spaced)
        at = self.remembered(low, high)
        new = np.flatnonzero(at < 0)
        ends, ids = self.tokenized([pieces[k] for k in new], spaced)
        # All ids in one row, those from memory before the new ones; then in the order of the pieces.
        old = np.flatnonzero(at >= 0)
        self.again[at[old]] = True
        sizes = np.zeros(len(pieces), np.int64)
        sizes[old], sizes[new] = self.last[at[old]] - self.first[at[old]], np.diff(ends, prepend=0)
        known = self.ids[run_of(self.first[at[old]], np.cumsum(sizes[old]))]
        begins = np.zeros(len(pieces), np.int64)
        begins[old], begins[new] = np.cumsum(sizes[old]) - sizes[old], len(known) + ends - sizes[new]
        if len(new):
            self.learn(low[new], high[new], ends, ids, at)
        out = np.cumsum(sizes)
        return out, np.concatenate([known, ids])[run_of(begins, out)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text, each with the end token."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        loose = pc.match_substring_regex(texts, self.LOOSE)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        if pc.any(loose).as_py():
            own = [self.JOINT.split(t) if odd else None for t, odd in zip(texts.to_pylist(), loose.to_pylist(), strict=True)]
            lists = pa.array([mine if mine is not None else plain.as_py() for mine, plain in zip(own, lists, strict=True)], pa.large_list(pa.large_string()))
        edges = np.asarray(lists.offsets, np.int64)
        flat = lists.values.slice(edges[0], edges[-1] - edges[0])
        edges = edges - edges[0]
        coded = flat.dictionary_encode()
        codes = np.array(coded.indices, np.int64)
        vocabulary = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # Without a space before them stand the first piece of a text (there is one), line breaks and what follows them.
        breaks = codes == (vocabulary.index("\n") if "\n" in vocabulary else -1)
        head = breaks.copy()
        head[1:] |= breaks[:-1]
        head[edges[:-1]] = True
        # A piece counts twice: as it is with a space before it and, behind all those, without.
        codes += len(vocabulary) * head
        seen = np.bincount(codes, minlength=2 * len(vocabulary)) > 0
        begin, length, ids = np.zeros(len(seen), np.int64), np.zeros(len(seen), np.int64), []
        before = 0
        for shift, spaced in ((0, True), (len(vocabulary), False)):
            mine = np.flatnonzero(seen[shift : shift + len(vocabulary)])
            last, found = self.ids_of([vocabulary[c] for c in mine], spaced)
            length[mine + shift] = np.diff(last, prepend=0)
            begin[mine + shift] = last - length[mine + shift] + before
            ids.append(found)
            before += len(found)
        first, sizes = begin[codes], length[codes]
        ends = np.cumsum(sizes)
        every = np.concatenate(ids)[run_of(first, ends)]
        bounds = np.concatenate([[0], ends])[edges]
        return [np.append(every[a:z], np.uint32(END)) for a, z in zip(bounds[:-1], bounds[1:], strict=True)]


def encoder(path: str) -> Encoder:
    """The Python worker's encoder: it lives as long as the worker, so that later tasks find what earlier ones learned."""
    state = sys.modules.setdefault("_tallyline_worker_state", types.ModuleType("_tallyline_worker_state"))
    known = state.__dict__.setdefault("encoders", {})
    if path not in known:
        known[path] = Encoder(path)
    return known[path]


def sharded(batches, path: str, shard_tokens: int):
    """The shards of one range of documents, which come in order."""
    coder, part, shard = encoder(path), TaskContext.get().partitionId(), 0
    ids, held, size = [], [], 0

    def blob():
        starts = np.cumsum([0, *map(len, held)])
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([size], pa.int64()),
             pa.array([packed(np.concatenate(held), ids, starts)], pa.binary())], names=["part", "shard", "n_docs", "n_tokens", "blob"])

    for batch in (piece for batch in batches for piece in pieces(batch, "text", AT_ONCE)):
        for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text")), strict=True):
            ids.append(doc_id)
            held.append(tokens)
            size += len(tokens)
            if size >= shard_tokens:
                yield blob()
                shard, ids, held, size = shard + 1, [], [], 0
    if ids:
        yield blob()
    ids, held = [], []
    given_back()


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode the documents (doc_id, text) and write the shards.

    The ranges are of doc_id and row number, so rows that share an id, or have none, are spread over as many as they need.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = columns_of(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("turn"))
    ordered = rows.repartitionByRange("doc_id", "turn").sortWithinPartitions("doc_id", "turn").select("doc_id", "text")
    shards = ordered.mapInArrow(lambda batches: sharded(batches, tokenizer, shard_tokens), SHARDS_SQL)
    # Blobs are compressed already, and a reader takes a row group at a time.
    shards.write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(path)


def decoded(batches):
    """One row for each document of the shards."""
    for batch in (whole.slice(k, 1) for whole in batches for k in range(whole.num_rows)):
        for part, shard, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "blob")), strict=True):
            matrix = WaveletMatrix(blob)
            tokens = matrix.tokens().astype("<u4")
            sums = [zlib.crc32(tokens[a:z].tobytes()) for a, z in zip(matrix.starts[:-1], matrix.starts[1:], strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array(matrix.doc_ids, pa.int64()),
                 pa.array(matrix.starts[:-1]), pa.array(np.diff(matrix.starts)), pa.array(sums, pa.int64())],
                names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])
            del blob, matrix, tokens, sums
    given_back()


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the shards."""
    shards = spark.read.schema(SHARDS_SQL).parquet(path)
    # Tokens before a part (one row for each range), and before a shard within its part.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part").alias("in_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    before = shards.select(
        F.col("part").alias("of_part"), F.col("shard").alias("of_shard"),
        (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")).alias("before_shard"))
    before = before.join(parts, F.col("of_part") == F.col("in_part"))
    rows = shards.mapInArrow(decoded, READ_SQL).join(before, (F.col("part") == F.col("of_part")) & (F.col("shard") == F.col("of_shard")))
    return rows.select("doc_id", (F.col("before_part") + F.col("before_shard") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
