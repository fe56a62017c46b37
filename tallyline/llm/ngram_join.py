"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

1. Every text becomes a set of hashed word n-grams (lower case, split at white space; a shorter text is one n-gram)
   and a MinHash signature; texts with the same words form a class, which counts as one text from then on.
2. The signature is cut into bands whose number and width follow from the target recall at the threshold. The
   classes are shuffled by band hash. Buckets with the same members are reduced to one.
3. A large bucket is dealt into blocks by hash, and every pair of blocks is a task of its own, so no task gets a whole
   hot bucket. A task intersects the full n-gram sets and returns one row for each class: how many documents it links
   to, and the smallest class of its cluster there. A pair that meets in several buckets counts in the first only.
4. Connected components over the clusters give every document its class.

Defined results: texts that are null or without words link with nothing. Rows without id get a row without links.
Rows that repeat an id and its words count as one document; other words of a
repeated id are a document of their own, which has a row, a class and links of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.frames import columns_of, settled
from tallyline.llm.words import given_back, hashed_words, mixed, per_text, pieces, shingles_of

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.999, 128
#: A block holds about so many classes, and so many n-grams in all.
BLOCK_CLASSES, BLOCK_NGRAMS = 128, 200_000
#: Texts are taken in steps of about so many n-grams; a longer text is a step of its own.
STEP = 100_000


def banding(threshold: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the widest bands that find a pair at the threshold with the target recall within the hash budget."""
    best = None
    for rows in range(1, most_hashes + 1):
        miss = 1 - threshold**rows
        needed = 1.0 if miss <= 0 else np.inf if miss >= 1 else np.ceil(np.log(1 - recall) / np.log(miss))
        if needed * rows <= most_hashes:
            best = (int(needed), rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def keys_of(hashes: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """The hash of every text's word sequence."""
    return [xxhash.xxh3_128_digest(hashes[a:z].tobytes()) for a, z in zip(starts[:-1], starts[1:], strict=True)]


def sets_of(texts: pa.Array, n: int):
    """Sorted distinct n-gram hashes of every text, where each text's begin, and the hash of its word sequence."""
    hashes, word_starts = hashed_words(texts)
    grams, starts = shingles_of(hashes, word_starts, n)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))]).astype(np.int64)
    return grams[new], starts, keys_of(hashes, word_starts)


def signed(batches, n: int, bands: int, rows: int):
    """(doc_id, text_hash, key, size, bands) of every text."""
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    for batch in (piece for batch in batches for piece in pieces(batch, "text")):
        grams, starts, keys = sets_of(batch.column("text"), n)
        out = np.zeros((len(keys), bands), np.uint64)
        first = 0
        while first < len(keys):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + STEP, "right")) - 1)
            mine, spans = grams[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
            for band in range(bands):
                value = np.full(last - first, band, np.uint64)
                for seed in seeds[band * rows : (band + 1) * rows]:
                    value = mixed(value + per_text(np.minimum, (mine ^ seed) * (seed | np.uint64(1)), spans, np.uint64(0)))
                out[first:last, band] = value
            first = last
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), pa.array(np.diff(starts), pa.int64()),
             pa.FixedSizeListArray.from_arrays(pa.array(out.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "key", "size", "bands"])
    given_back()


def dealt(batches, n: int):
    """Every class once for each block pair it takes part in, with its n-gram set."""
    for batch in (piece for batch in batches for piece in pieces(batch, "text")):
        grams, starts, _ = sets_of(batch.column("text"), n)
        rep, members = batch.column("rep").to_pylist(), batch.column("members").to_pylist()
        rows, weight = [], 0
        for t, buckets in enumerate(batch.column("buckets").to_pylist()):
            sets = grams[starts[t] : starts[t + 1]].tobytes()
            known = sorted(b["bucket"] for b in buckets)
            for b in buckets:
                blocks = b["blocks"]
                mine = xxhash.xxh3_64_intdigest(str(rep[t]).encode()) % blocks
                for other in range(blocks):
                    rows.append((b["bucket"], min(mine, other), max(mine, other), mine, rep[t], members[t], known, sets))
                    weight += len(sets) + 100
                    if weight > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(DEALT.names, r, strict=True)) for r in rows], DEALT)
                        rows, weight = [], 0
        yield pa.RecordBatch.from_pylist([dict(zip(DEALT.names, r, strict=True)) for r in rows], DEALT)
    given_back()


DEALT = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32()), ("rep", pa.int64()),
                   ("members", pa.int64()), ("known", pa.list_(pa.int64())), ("grams", pa.large_binary())])
DEALT_SQL = "bucket bigint, i int, j int, block int, rep bigint, members bigint, known array<bigint>, grams binary"
LINKED = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[place] > 1
    owner, place = owner[common], (np.cumsum(times > 1) - 1)[place[common]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width, count = 4096, int((times > 1).sum())
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for first in range(0, count, width):
        a, z = np.searchsorted(place, [first, first + width])
        there = np.zeros((len(sets), min(width, count - first)), np.float32)
        there[owner[a:z], place[a:z] - first] = 1
        out += there @ there.T
    return out


def cluster_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest position that every position reaches."""
    root = np.arange(len(linked))
    while True:
        near = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root)))
        near = near[near]
        if (near == root).all():
            return root
        root = near


def verified(group: pa.Table, threshold: float) -> pa.Table:
    """The links between the two blocks of a bucket (or within the block, if it is one)."""
    group = group.combine_chunks()
    group = group.take(pa.array(np.unique(np.asarray(group.column("rep")), return_index=True)[1]))  # a repeated row counts once
    i, j, bucket = (group.column(c)[0].as_py() for c in ("i", "j", "bucket"))
    sets = [np.frombuffer(b.as_py(), np.uint64) for b in group.column("grams")]
    sizes = np.array([len(s) for s in sets], np.float64)
    shared = shared_counts(sets).astype(np.float64)
    linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(linked, False)
    block = np.asarray(group.column("block"))
    if i != j:
        linked &= block[:, None] != block[None, :]
    known = [[b for b in row.as_py() if b < bucket] for row in group.column("known")]
    earlier = {b: k for k, b in enumerate(sorted({b for row in known for b in row}))}
    there = np.zeros((len(sets), len(earlier)), np.float32)
    for t, row in enumerate(known):
        there[t, [earlier[b] for b in row]] = 1
    first_here = linked & (there @ there.T == 0)
    members, reps = np.asarray(group.column("members")), np.asarray(group.column("rep"))
    roots = reps[cluster_roots(linked)]
    full = np.flatnonzero(linked.any(axis=1))
    return pa.Table.from_arrays([pa.array(reps[full]), pa.array((first_here @ members)[full]), pa.array(roots[full])], schema=LINKED)


def join(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each doc_id and its words: doc_id, copy_of, n_links, class_id, kept, text_hash.

    copy_of is the smallest doc_id with the same words, n_links the number of other documents whose n-gram sets have a
    Jaccard similarity of at least the threshold, class_id the smallest doc_id that can be reached over links, kept
    whether the document is the one of its class that stays (one with that smallest id), text_hash the xxhash64 of its text.
    """
    bands, rows = banding(threshold, recall)
    texts = columns_of(docs, doc_id="bigint", text="string")
    named = texts.filter("doc_id IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    signs = named.mapInArrow(lambda batches: signed(batches, n, bands, rows), "doc_id bigint, text_hash bigint, key binary, size bigint, bands array<bigint>")
    one = settled(signs.groupBy("doc_id", "key").agg(F.min(F.struct("text_hash", "size", "bands")).alias("s")).select("doc_id", "key", "s.*"))
    # Classes have numbers of their own: an id with several texts may be the smallest of several classes.
    same = one.filter("size > 0").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("members"), F.min(F.struct("size", "bands")).alias("s"))
    classes = settled(same.select("key", F.col("first.doc_id").alias("least"), F.col("first.text_hash").alias("first_hash"), "members", "s.size", "s.bands", F.monotonically_increasing_id().alias("rep")))
    spread = classes.select("rep", "size", F.explode("bands").alias("bucket"))
    buckets = (
        spread.groupBy("bucket").agg(
            F.count("*").alias("n"), F.sum("size").alias("ngrams"),
            F.bit_xor(F.xxhash64("rep")).alias("mark"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("mark2"))
        .filter("n > 1").groupBy("n", "mark", "mark2").agg(F.min(F.struct("bucket", "ngrams")).alias("b"))
        .select(F.col("b.bucket").alias("kept_bucket"),
                F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("b.ngrams") / BLOCK_NGRAMS)).alias("blocks")))
    chosen = (
        spread.join(buckets, F.col("bucket") == F.col("kept_bucket"))
        .groupBy("rep").agg(F.collect_set(F.struct("bucket", "blocks")).alias("buckets")))  # at most one per band
    weighed = chosen.join(classes.select(F.col("rep").alias("r"), "least", "first_hash", "members", F.col("key").alias("k")), F.col("rep") == F.col("r")).drop("r")
    # The row that gave the class its place; its id alone may be that of many rows.
    taken = named.join(weighed, (F.col("doc_id") == F.col("least")) & (F.col("text_hash") == F.col("first_hash"))).select("rep", "members", "buckets", "text", "k")
    pairs = taken.mapInArrow(lambda batches: dealt(_with_key(batches), n), DEALT_SQL)
    found = settled(
        pairs.groupBy("bucket", "i", "j").applyInArrow(lambda group: verified(group, threshold), "rep bigint, links bigint, root bigint"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "linked_rep")
    links = found.groupBy(F.col("rep").alias("counted_rep")).agg(F.sum("links").alias("links"))
    linked = settled(
        classes.select("key", "least", "rep", "members")
        .join(links, F.col("rep") == F.col("counted_rep"), "left").join(roots, F.col("rep") == F.col("linked_rep"), "left")
        .select("key", "least", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("root")))
    # Of each component the smallest id, and of its texts one.
    first = linked.groupBy(F.col("root").alias("component")).agg(F.min(F.struct("least", "key")).alias("first"))
    of_class = linked.join(first, F.col("root") == F.col("component")).select(F.col("key").alias("class_key"), "least", "links", "first")
    out = one.select("doc_id", "text_hash", F.when(F.col("size") > 0, F.col("key")).alias("key")).join(of_class, F.col("key") == F.col("class_key"), "left").select(
        "doc_id", F.coalesce("least", "doc_id").alias("copy_of"), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("first.least", "doc_id").alias("class_id"),
        F.coalesce((F.col("doc_id") == F.col("first.least")) & (F.col("key") == F.col("first.key")), F.lit(True)).alias("kept"), "text_hash")
    nameless = texts.filter("doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("copy_of"), F.lit(0).cast("bigint").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), F.xxhash64("text").alias("text_hash"))
    return out.unionByName(nameless)


def _with_key(batches):
    """Rows whose words hash to the key of the class, each class once a task: equal rows are dealt to the same one."""
    seen: set[int] = set()
    for batch in (piece for batch in batches for piece in pieces(batch, "text")):
        keys = keys_of(*hashed_words(batch.column("text")))
        new = []
        for key, wanted, rep in zip(keys, batch.column("k").to_pylist(), batch.column("rep").to_pylist(), strict=True):
            new.append(key == wanted and rep not in seen)
            if new[-1]:
                seen.add(rep)
        yield batch.filter(pa.array(new, pa.bool_()))
