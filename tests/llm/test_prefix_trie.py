"""The prefix trie against plain Python, over many small shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyline.llm import prefix_trie
from tallyline.llm.double_array import DoubleArray, nodes_of

SHAPE = "conv_id bigint, turn bigint, role string, text string, depth int, n_convs string, shard double"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SHAPE)


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, sums = set(), {}
    for path in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[path]]
        saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        sums[path] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
        out.add((members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(children[path]), *sums[path],
                 hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()))
    return out


def invented(seed, count=120):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        c = rng.choice([k, 100 + k, -k, 1000 + 100 * k])
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9, 14])):
            rows.append((c, rng.choice([turn, turn, turn, None, 3]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "bb", "bb", "ccc ü", None, "\U0001f600"])))
    return rows


def check(spark, rows, most, parts=3):
    found = prefix_trie.nodes(conversations(spark, rows).repartition(parts), most)
    assert found.columns == prefix_trie.RESULT
    got = [tuple(r) for r in found.collect()]
    want = plain(rows)
    assert len(got) == len(set(got)) == len(want) and set(got) == want
    return want


@pytest.mark.parametrize("most", [1, 5, 40, 100_000])
def test_random_conversations(spark, most):
    want = check(spark, invented(most), most)
    assert any(r[5] > 5 for r in want) and any(r[6] > 50 for r in want)


def test_shards_inside_a_long_common_beginning(spark):
    """Many shards lie wholly below one long beginning, and paths end on the way."""
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 60) for t in range(20)]
    rows += [(c, 20 + t, "user", f"own {c % 13} {t}") for c in range(1, 60) for t in range(c % 4)]
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(1, 30) for t in range(6, c)]
    check(spark, rows, 30)


def test_a_hot_conversation_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", "the same") for c in range(1_000, 1_400) for t in range(7)] + [(9, 1, "user", "long")] * 700 + [(10, 5, "a", "z" * 100_000), (10, 4, "a", "z" * 100_000)]
    check(spark, rows, 50)


def test_turnless_and_odd_rows(spark):
    base = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 3)
    rows = [(base, 1, "user", "goes"), (base, 2, "user", "too"), (None, 1, "user", "nobody's"), (-205, None, None, None), (-205, 0, "", ""), (7, 1, "user", "")]
    want = check(spark, rows, 10)
    assert any(r[1] == 0 and r[3] == 3 for r in want)


def test_nothing(spark):
    assert prefix_trie.nodes(conversations(spark, [(1, 1, "a", "b")]).limit(0)).collect() == []
    assert prefix_trie.nodes(conversations(spark, [(None, 1, "a", "b")])).collect() == []


def test_double_arrays_hold_just_their_sequences():
    rng = random.Random(5)
    for wide in (3, 50, 4_000):
        seqs = sorted({tuple(rng.randrange(wide) for _ in range(rng.randint(0, 7))) for _ in range(900)})
        ids, starts = np.array([x for s in seqs for x in s]), np.cumsum([0, *map(len, seqs)])
        parents, labels, ends = nodes_of(ids, starts)
        trie, slot = DoubleArray.packed(parents, labels)
        prefixes = {s[:k] for s in seqs for k in range(len(s) + 1)}
        assert len(parents) + 1 == len(prefixes) == len(set(slot.tolist()))
        for s, end in zip(seqs, ends, strict=True):
            met = trie.walk(np.array(s, np.int64))
            assert len(met) == len(s) + 1 and met[-1] == slot[end]
        for _ in range(300):
            s = tuple(rng.randrange(wide + 1) for _ in range(4))
            assert len(trie.walk(np.array(s))) - 1 == max(k for k in range(5) if s[:k] in prefixes)
        assert [len(x) for x in trie.levels()] == [sum(len(p) == d for p in prefixes) for d in range(max(map(len, prefixes)) + 1)]
        assert len(trie.check) <= 3 * (len(prefixes) + wide)
