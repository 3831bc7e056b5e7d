"""Every stage of the pipeline on its own input, against brute force; the whole run; odd rows."""

import public_tokenizers
import pytest
from conftest import SF_DIR
from test_decontamination import brute as contaminated
from test_jaccard_join import brute as similar
from test_line_dedup import brute as without_lines
from test_packing import VOCABULARY, check_layout, expected_pieces
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.common import benchmark, documents, labels
from tidemark.llm.quality_rank import quality_scores


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before each stage, and the result of the last, as rows."""
    docs = documents(spark, SF_DIR)
    found = [docs.collect()]
    schema = docs.schema
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(found[-1], schema)
        found.append(stage(spark, docs, SF_DIR).collect())
    return found


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_names_and_columns(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_duplicates", "benchmark_decontamination", "best_fit_packing",
    ]
    for rows in steps[:-1]:
        assert rows[0].__fields__ == documents(spark, SF_DIR).columns


def test_quality_keeps_what_the_ranking_accepts(spark, steps):
    judged = quality_scores(documents(spark, SF_DIR), labels(spark, SF_DIR)).collect()
    assert texts(steps[1]).keys() == {r.doc_id for r in judged if r.predicted}
    good = {r.doc_id for r in labels(spark, SF_DIR).collect() if r.quality == 1}
    assert len(good & texts(steps[1]).keys()) >= 0.97 * len(good)


def test_line_dedup(steps):
    assert texts(steps[2]) == without_lines(list(texts(steps[1]).items()))


def test_one_of_each_group(steps):
    groups = similar(list(texts(steps[2]).items()))
    assert texts(steps[3]).keys() == {d for d, (_, c) in groups.items() if c == d}


def test_decontamination(spark, steps):
    items = [(r.item_id, r.text) for r in benchmark(spark, SF_DIR).collect()]
    bad = {d for d, _, _ in contaminated(list(texts(steps[3]).items()), items)}
    assert texts(steps[4]).keys() == texts(steps[3]).keys() - bad


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = [p for d, t in texts(steps[4]).items() for p in expected_pieces(tokenizer, d, t)]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in steps[5]]
    assert sorted(got) == sorted(want)
    assert check_layout(steps[5]) <= 1.05 * sum(p[3] for p in want) / 2048 + 1


def test_run_gives_the_same_pieces(spark, steps):
    got = sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == sorted((r.doc_id, r.piece, r.ids_crc32) for r in steps[5])


def test_odd_rows_pass_through_every_stage(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, h int, words string"
    odd = [(None, "a line of text", None, None, None, 1, "x"), (-1, None, "en", None, 0, None, None)]
    odd += [(-2, "", None, "s", 0, 2, "y"), (-3, "One two three.\n" * 3, "en", "s", 45, 3, "z")] * 2
    docs = spark.createDataFrame(odd, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "h", "words"], name
    pieces = corpus_pipeline.best_fit_packing(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
