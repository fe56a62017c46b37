"""Mixing and line dedup against plain Python."""

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest

from tallyline.llm import line_dedup, mixing
from tests.llm import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(folder):
    return [tuple(r.values()) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]


@pytest.mark.parametrize("entropy, repeats", [(0.95, 4.0), (0.999, None), (1.0, 1.5), (0.2, 4.0)])
def test_mixture_equals_the_plain_one(spark, folder, entropy, repeats):
    rows = documents(folder) + [(None, "a b", None, None, 1), (7, None, None, "src1", None), (8, "", None, "void", 0), (9, "x y z", None, "src1", 1), (9, "x y z", None, "src1", 1)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS), entropy, repeats)
    found = Counter((r.doc_id, r.source, r.n_tokens, round(r.weight, 9), r.copies) for r in got.collect())
    assert found == brute.mixture([(r[0], r[3], r[1]) for r in rows], entropy, repeats or 1e9)


def test_blocks_are_walked_in_order(spark, folder, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    rows = documents(folder)
    got = Counter((r.doc_id, r.source, r.n_tokens, round(r.weight, 9), r.copies) for r in mixing.mixed(spark.createDataFrame(rows, DOCS)).collect())
    assert got == brute.mixture([(r[0], r[3], r[1]) for r in rows], block_tokens=300)
    assert min(k[4] for k in got) >= 1


def test_a_budget_below_the_corpus_drops_documents_to_fit(spark, folder):
    rows = documents(folder)
    got = mixing.mixed(spark.createDataFrame(rows, DOCS), budget=5_000).collect()
    assert len(got) == len(rows) and 0 < sum(r.copies * r.n_tokens for r in got) <= 5_000


def test_mixing_nothing(spark):
    assert mixing.mixed(spark.createDataFrame([], DOCS)).collect() == []
    one = mixing.mixed(spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)).collect()
    assert [(r.copies, r.weight) for r in one] == [(1, 1.0)]


def check_lines(spark, rows, **options):
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), **options).collect()
    want = brute.line_dedup(rows, **options)
    by = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got)
    expected = Counter((d, *want.get((d, t), (t, 0 if t is None else t.count("\n") + 1, 0))) for d, t in rows)
    assert by == expected
    return got


def test_lines_equal_the_plain_ones(spark, folder):
    got = check_lines(spark, [(r[0], r[1]) for r in documents(folder)])
    assert any(r.n_removed for r in got)


def test_runs_of_random_lines(spark):
    draw = random.Random(3)
    lines = [" ".join(draw.choice("abcdefgh") * 3 for _ in range(draw.randint(0, 9))) for _ in range(40)]
    rows = []
    for d in range(60):
        text = [draw.choice(lines) for _ in range(draw.randint(0, 12))]
        for _ in range(draw.randint(0, 3)):
            first = draw.randint(0, 30)
            text += lines[first : first + draw.randint(1, 9)]
        rows.append((d if d % 17 else 5, "\n".join(text)))
    rows += [(None, rows[3][1]), (3, None), (99, ""), rows[4], rows[4], (100, "\n\n"), (101, " ".join(["w"] * 300)), (102, " ".join(["w"] * 300) + " ")]
    for options in ({"min_words": 12, "window": 3}, {"min_words": 5, "window": 1}, {}):
        got = check_lines(spark, rows, **options)
        assert sum(r.n_removed for r in got) > 0


def test_no_documents(spark):
    assert line_dedup.dedup(spark.createDataFrame([], "doc_id bigint, text string, k int, gone int")).collect() == []
