"""Registered queries against SQL, and the pipeline against plain Python."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import decontaminate, stages, toxicity
from tallyline.llm.frames import table
from tallyline.llm.queries import ORACLES, QUERIES
from tests.harness import compare, connect
from tests.llm import brute
from tests.llm.test_pairs import brute_links
from tests.llm.test_texts import plain_distance, plain_words


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_agrees_with_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    assert compare(spark, connect(folder), folder, name, QUERIES, ORACLES) is None


def test_the_mixture_repeats_documents(spark):
    copies = [r.copies for r in QUERIES["op6_mixing"](spark, "/root/testdata/sf0.01").collect()]
    assert min(copies) == 1 and max(copies) > 1


def test_names_and_numbers():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_every_stage_against_the_plain_one(spark, folder):
    from tokenizers import Tokenizer

    from tallyline.llm.tokens import END, tokenizer_path

    # One source holds two thirds of the documents, so that the mixture differs from the corpus.
    source = F.when(F.col("doc_id") % 3 != 0, "src0").otherwise(F.col("source"))
    docs = table(spark, folder, "documents").withColumns({"source": source, "score": F.lit("mine")})
    items = [r["text"] for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    for name, stage in stages.STAGES[:-1]:
        before = [r.asDict() for r in docs.collect()]
        result = stages.between(stage(spark, docs, folder), name)
        assert result.columns == docs.columns and dict(result.dtypes) == dict(docs.dtypes)
        after = sorted((r.asDict() for r in result.collect()), key=str)
        if name == "toxicity":
            # The score is a function of the text alone, whatever rows stand beside it.
            scores = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score(docs, model, F.col("text")).alias("s")).collect()}
            want = [r for r in before if scores[r["doc_id"]] < toxicity.CUT]
        elif name == "near_duplicates":
            ids = sorted(r["doc_id"] for r in before)
            words = {r["doc_id"]: (r["text"] or "").lower().split() for r in before}
            sets = [{tuple(words[d][k : k + 5]) for k in range(max(1, len(words[d]) - 4))} if words[d] else set() for d in ids]
            links = brute_links(ids, lambda a, b, s=sets: bool(s[a] & s[b]) and len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]) - 1e-9)
            want = [r for r in before if links[r["doc_id"]][1] == r["doc_id"]]
        elif name == "decontamination":
            plain = [plain_words(t) for t in items]
            grams = [{tuple(p[a:z]) for a, z in decontaminate.cut(len(p), int(decontaminate.RATE * len(p)) + 1)} for p in plain]

            def leaks(text):
                words = plain_words(text)
                found = {tuple(words[k : k + n]) for n in {len(g) for own in grams for g in own} for k in range(len(words) - n + 1)}
                return any(own & found and plain_distance(p, words) <= int(decontaminate.RATE * len(p)) for p, own in zip(plain, grams, strict=True))

            want = [r for r in before if not leaks(r["text"])]
        else:
            copies = {(k[0], k[1], k[2]): k[4] for k in brute.mixture([(r["doc_id"], r["source"], r["text"]) for r in before])}
            want = [r for r in before for _ in range(next(n for k, n in copies.items() if k[0] == r["doc_id"]))]
        assert after == sorted(want, key=str), name
        assert want and (len(want) != len(before))
        docs = result
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    plain, start = Tokenizer.from_file(tokenizer_path()), 0
    got = stages.STAGES[-1][1](spark, docs, folder).orderBy("start").collect()
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*plain.encode(text, add_special_tokens=False).ids, END]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        start += len(ids)


def test_stages_keep_odd_rows(spark, folder):
    """Missing ids, texts and sources, repeated rows and clashing names pass every stage but those that drop them on purpose."""
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint, class_id int, kept string, __score double, n_tokens int"
    rows = [(None, None, None, None, None, 1, "a", 0.5, 2), (None, "no id", None, None, 5, 1, "a", 0.5, 2), (900, "", "en", None, 0, 1, "a", 0.5, 2), (901, None, "en", "s", None, 1, "a", 0.5, 2),
            (902, "same words here", "en", "s", 3, 1, "a", 0.5, 2), (902, "same words here", "en", "s", 3, 1, "a", 0.5, 2), (903, "w " * 30_000, "en", "t", 3, 1, "a", 0.5, 2)]
    docs = spark.createDataFrame(rows, shape)
    for name, stage in stages.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        kept = sorted((tuple(r) for r in out.collect()), key=str)
        expected = sorted(rows, key=str) if name != "near_duplicates" else sorted([*rows[:4], rows[4], rows[6]], key=str)
        if name == "mixing":
            assert {str(k) for k in kept} == {str(r) for r in rows} and len(kept) >= len(rows)
        else:
            assert kept == expected, name
        assert stage(spark, docs.limit(0), folder).count() == 0
    last = stages.STAGES[-1][1]
    assert last(spark, docs, folder).count() == len(rows) and last(spark, docs.limit(0), folder).count() == 0
