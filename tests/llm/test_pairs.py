"""N-gram join, vector index and components against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from tallyline.llm import multi_index, ngram_join
from tallyline.llm.components import components

SHAPE = "doc_id bigint, text string, rep string, key int, class_id string"


def brute_links(ids, similar):
    """-> {id: (links, smallest id reached)} for a symmetric relation on positions; ids are unique."""
    return dict(zip(ids, brute_rows(ids, similar), strict=True))


def brute_rows(ids, similar):
    """-> [(links, smallest id reached)] by position; ids may repeat."""
    root = list(range(len(ids)))
    links = [0] * len(ids)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if similar(a, b):
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)), key=lambda i: ids[i])
                root[y] = x
    return [(links[a], ids[top(a)]) for a in range(len(ids))]


def check_texts(spark, rows, threshold=0.8):
    got = ngram_join.join(spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SHAPE), threshold=threshold).collect()
    entries = sorted({(d, tuple((t or "").lower().split())) for d, t in rows if d is not None})
    sets = [{words[k : k + 5] for k in range(max(1, len(words) - 4))} if words else set() for _, words in entries]

    def similar(a, b):
        n = len(sets[a] & sets[b])
        return n > 0 and n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9

    want = brute_rows([d for d, _ in entries], similar)
    mine = [r for r in got if r.doc_id is not None]
    assert Counter((r.doc_id, r.n_links, r.class_id) for r in mine) == Counter((d, *w) for (d, _), w in zip(entries, want, strict=True))
    assert all(r.doc_id == r.class_id for r in mine if r.kept)
    # One document of each class stays; of one without links there is no other.
    roots = Counter(c for (n, c) in want if n)
    assert Counter(r.class_id for r in mine if r.kept and r.n_links).keys() == roots.keys()
    if len({d for d, _ in entries}) == len(entries):
        assert all(r.kept == (r.doc_id == r.class_id) for r in mine)
    assert sum(r.doc_id is None for r in got) == sum(d is None for d, _ in rows)
    return got


def test_documents_against_all_pairs(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]
    assert any(r.n_links for r in check_texts(spark, rows))


def test_a_hot_group_of_near_copies_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 16)
    draw = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for d in range(90):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(120)] = f"x{draw.random()}"
        rows.append((d, " ".join(words)))
    rows += [(200 + d, " ".join(f"y{draw.random()}" for _ in range(30))) for d in range(20)]
    rows += [(300, rows[0][1].upper()), (301, rows[0][1].replace(" ", "\n ")), (302, rows[1][1])]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "short text"), (404, "Short  text"), (405, "a " * 60_000), (406, "a " * 50_000), (None, rows[0][1]), (None, None)]
    rows += [rows[0], rows[0]]
    got = {r.doc_id: r for r in check_texts(spark, rows)}
    assert got[404].class_id == 403 and got[300].copy_of == min(d for d, t in rows if d is not None and (t or "").lower().split() == rows[0][1].split())
    assert got[401].n_links == 0 and got[406].class_id == 405


def test_every_text_of_a_repeated_id_is_compared(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    got = check_texts(spark, [(1, a), (1, b), (2, a), (3, b + " more"), (4, c), (4, c), (5, None), (5, ""), (6, c + " end"), *[(9, f"{c} {k}") for k in range(30)]])
    by = {(r.doc_id, r.n_links, r.class_id, r.kept) for r in got}
    assert {(2, 1, 1, False), (3, 1, 1, False), (1, 1, 1, True)} <= by


def test_two_texts_of_an_id_in_one_class_leave_one(spark):
    a = " ".join(f"a{k}" for k in range(60))
    got = check_texts(spark, [(1, a), (1, a + " x"), (2, a + " y")])
    assert sum(r.kept for r in got) == 1 and all(r.n_links == 2 and r.class_id == 1 for r in got)


def test_the_stage_keeps_each_text_of_a_repeated_id(spark):
    from tallyline.llm.stages import without_near_duplicates

    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(1, a, 0), (1, a, 1), (1, a.upper(), 2), (1, b, 3), (2, a, 4), (3, b + " more", 5), (None, a, 6), (7, None, 7), (7, None, 8)]
    out = without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string, kept int"), "").collect()
    assert sorted(((r.doc_id, (r.text or "").lower()) for r in out), key=str) == sorted([(1, a), (1, b), (None, a), (7, "")], key=str)


def test_no_documents(spark):
    assert ngram_join.join(spark.createDataFrame([], SHAPE)).collect() == []


def test_banding_reaches_the_recall():
    for threshold in (0.5, 0.8, 0.95, 1.0):
        bands, rows = ngram_join.banding(threshold, 0.999)
        assert bands * rows <= ngram_join.MOST_HASHES and 1 - (1 - threshold**rows) ** bands >= 0.999 - 1e-9


def test_components_of_random_links(spark):
    draw = random.Random(5)
    links = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    nodes = sorted({x for link in links for x in link})
    pairs = {frozenset(link) for link in links}
    want = brute_links(nodes, lambda a, b: frozenset((nodes[a], nodes[b])) in pairs)
    assert got == {n: w[1] for n, w in want.items() if w[0]}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def check_vectors(spark, rows, kind="array<float>"):
    got = multi_index.join(spark.createDataFrame([(*r, 0, "x") for r in rows], f"vec_id bigint, embedding {kind}, rep int, home string")).collect()
    named = [r for r in rows if r[0] is not None]
    width = max(len(v) for _, v in named if v)
    units = []
    for _, vector in named:
        v = np.array([np.nan if x is None else np.float32(x) if "float" in kind else x for x in vector or []], float)
        units.append(np.pad(v / np.linalg.norm(v), (0, width - len(v))) if len(v) and np.isfinite(v).all() and v.any() else None)
    want = brute_rows([i for i, _ in named], lambda a, b: units[a] is not None and units[b] is not None and units[a] @ units[b] >= 0.95)
    mine = [r for r in got if r.vec_id is not None]
    assert len(mine) == len(named) and all(r.kept == (r.vec_id == r.component_id) for r in mine)
    linked, right = sum(w[0] for w in want), sum(r.n_links for r in mine)
    assert 0.97 * linked <= right <= linked
    return got, Counter((r.vec_id, r.n_links, r.component_id) for r in mine) == Counter((i, *w) for (i, _), w in zip(named, want, strict=True))


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    draw = np.random.default_rng(2)
    centers = draw.normal(size=(40, 24))
    rows = [(k, (centers[k % 40] + draw.normal(scale=0.22, size=24)).tolist()) for k in range(500)]
    rows += [(1000 + k, (centers[0] + draw.normal(scale=0.05, size=24)).tolist()) for k in range(80)]
    rows += [(2000 + k, rows[3][1]) for k in range(5)] + [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [1.0, None]), (3004, [float("nan")] * 24), (3005, [float("inf")] * 24)]
    rows += [(3006, [1.0]), (3007, [2.0, 0.0]), (None, rows[3][1]), (None, None), rows[5]]
    got, same = check_vectors(spark, rows)
    assert len(got) == len(rows)


def test_every_vector_of_a_repeated_id_is_compared(spark):
    got, same = check_vectors(spark, [(1, None), (1, [1.0, 0.0]), (2, [1.0, 0.001]), (1, [0.0, 1.0]), (3, [0.001, 1.0]), (3, [0.001, 1.0])], "array<double>")
    assert same and sorted((r.vec_id, r.n_links) for r in got) == [(1, 0), (1, 1), (1, 2), (2, 1), (3, 2), (3, 2)]


def test_few_vectors(spark):
    assert check_vectors(spark, [(1, [1.0, 0.0]), (2, [0.99, 0.01]), (3, [0.0, 1.0])], "array<double>")[1]
    assert check_vectors(spark, [(4, [1e300, 0.0])], "array<double>")[1]
    assert multi_index.join(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
