"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import spelling

SHAPE = "doc_id bigint, text string, word int, n string, run double, `key` string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5, "k") for r in rows], SHAPE)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at:] == b[at + 1 :] or len(a) == len(b) and a[at + 1 :] == b[at + 1 :]


def plain(rows):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return root(forms[w]) if forms[w] else w

    return {(w, forms[w], root(w), n, len(near[w]), words.get(forms[w])) for w, n in words.items()}


def invented(seed, chains=True):
    rng = random.Random(seed)
    letters = "abeinréß×"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(40)]
    words += [w[:k] + rng.choice(letters) + w[k + e :] for w in words for e in (0, 1) for k in [rng.randrange(len(w))]]
    words += ["aaaaaa", "aaaaaaa", "aaabaaa", "zzzzzzz", "zzzzzz"]
    texts = [(rng.choice([None, rng.randrange(50)]), " ".join(rng.choice(words).title() + rng.choice([",", "", "9", "\n"]) for _ in range(40))) for _ in range(60)]
    if chains:  # five words, each five times as frequent as the one before and one letter away
        for k, w in enumerate(["chainx", "chainy", "chaizy", "chabzy", "cgabzy"]):
            texts.append((1000 + k, f"{w} " * (5 * 5**k)))
    return texts


@pytest.mark.parametrize("symbols", [None, 2, 5])
def test_all_pairs(spark, symbols):
    rows = invented(3) + [(None, None), (1, ""), (2, "1234 !"), (7, "short words only"), (8, "x" * 300_000), (9, ("verylongword" * 4_000 + " ") * 6), (10, ("verylongword" * 4_000 + "s ") * 40)]
    got = {tuple(r) for r in spelling.variants(documents(spark, rows).repartition(5), symbols).collect()}
    want = plain(rows)
    assert got == want
    assert any(r[1] and r[1] != r[2] for r in want) and any(r[4] > 1 for r in want)


def test_nothing_of_the_vocabulary_is_broadcast(spark):
    rows = invented(4)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "64")
    try:
        got = [tuple(r) for r in spelling.variants(documents(spark, rows)).collect()]
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    want = plain(rows)
    assert set(got) == want and len(got) == len(want) and any(r[1] and r[1] != r[2] for r in want)


def test_lookups_are_not_broadcast_by_their_estimate(spark):
    words = spark.range(2_000).selectExpr("id", "concat('word', translate(id, '0123456789', 'abcdefghij')) AS word", "id AS n")
    plan = spelling.near_pairs(words, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_repeated_rows_count(spark):
    rows = [(1, "repeated"), (1, "repeated")] * 3
    assert [tuple(r) for r in spelling.variants(documents(spark, rows)).collect()] == [("repeated", None, "repeated", 6, 0, None)]


def test_nothing(spark):
    empty = documents(spark, [(1, "a")]).limit(0)
    assert spelling.variants(empty).collect() == [] and spelling.variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_ties_take_the_smallest_word(spark):
    rows = [(1, "letter " * 25 + "lettem " * 25 + "letteq " * 5)]
    got = {r.word: (r.form, r.n_near) for r in spelling.variants(documents(spark, rows)).collect()}
    assert got == {"letter": (None, 2), "lettem": (None, 2), "letteq": ("lettem", 2)}


def test_roots_of_long_chains(spark):
    forms = [(f"w{k:02}", f"w{k + 1:02}") for k in range(17)] + [("lone", "w05")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "w17" for w, _ in forms}


@pytest.mark.parametrize("symbols", [2, 3, 7])
def test_neighbourhoods_meet_every_pair_once(symbols, monkeypatch):
    monkeypatch.setattr(spelling, "AT_ONCE", 200)
    rng = random.Random(symbols)
    words = list({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(300)})
    keys, looked = {}, Counter()
    for places, letters in spelling.reduced(words, symbols):
        for p, k in zip(places, spelling.summed(letters)[:, -1], strict=True):
            keys[words[p]] = int(k)
        for rows, found in spelling.neighbourhood(letters, symbols):
            looked.update((words[places[r]], int(k)) for r, k in zip(rows, found, strict=True))
    assert max(looked.values()) == 1
    symbol = {w: tuple(np.concatenate([m[0] for _, m in spelling.reduced([w], symbols)]).tolist()) for w in words}
    for a in words:
        for b in words:
            ra, rb = symbol[a], symbol[b]
            if ra == rb or one_edit(ra, rb):
                assert ((a, keys[b]) in looked) + ((b, keys[a]) in looked) == (2 if ra == rb else 1)
