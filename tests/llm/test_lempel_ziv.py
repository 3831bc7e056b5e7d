"""Removed words against a plain search for earlier windows; odd rows; streams in small batches."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF_DIR

from tidemark.llm.common import documents
from tidemark.llm.lempel_ziv import anchored_blocks, joined_spans, remove_repeated_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = set()
        for start in range(len(words) - window + 1):
            run = tuple(words[start : start + window])
            if run in seen:
                gone.update(range(start, start + window))
            seen.add(run)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {
        r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept)
        for r in remove_repeated_passages(docs).collect()
    }
    assert got == brute(rows)


def test_whole_table(spark):
    check(spark, [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()])


def passages(seed):
    """Texts of pieces of common passages, of few words and of many, with repeats inside a text."""
    rng = random.Random(seed)
    few, many = ["a", "b"], [f"w{i}" for i in range(50)]
    pool = [rng.choices(rng.choice([few, many, many]), k=rng.choice([19, 20, 25, 40, 90])) for _ in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.choice([0, 1, 2, 4])):
            piece = rng.choice(pool)
            at = rng.randrange(len(piece))
            words += piece if rng.random() < 0.5 else piece[at : at + rng.choice([5, 21, 30])]
            words += rng.choices(many, k=rng.choice([0, 0, 1, 6]))
        rows.append((i * 13 % 61, "\n".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(spark, seed):
    check(spark, passages(seed))


def test_tiny_arrow_batches(spark):
    """Groups that go over the ends of batches of the sorted streams."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, 3)
    try:
        check(spark, passages(4))
    finally:
        spark.conf.unset(setting)


def test_one_word_over_and_over(spark):
    check(spark, [(1, "x " * 70), (2, "x " * 19), (3, "x " * 20), (4, "y " * 21)])


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    odd = [(None, passage, "a", 1), (1, None, "b", 2), (2, "", "c", 3), (3, f"x\t{passage}", "d", 4)]
    odd += [(3, f"x\t{passage}", "d", 4), (4, f"{passage}\x0by\x1cz", "e", 5), (5, "q " * 60_000, None, None)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, start string, words int")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in remove_repeated_passages(docs).collect()), key=repr)
    want = [(None, 25, 0), (1, 0, 0), (2, 0, 0), (3, 26, 0), (3, 26, 0), (4, 26, 25), (5, 60_000, 59_999)]
    want[-1] = (5, 60_000, 59_999)
    assert got == sorted(want, key=repr)
    assert remove_repeated_passages(docs.limit(0)).count() == 0
    assert "kept" not in remove_repeated_passages(docs, with_text=False).columns


def test_blocks_cover_every_window_once():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 5, 300).astype(np.uint64)
    ends = np.array([0, 10, 29, 49, 49, 150, 300])
    begin, windows, _, _ = anchored_blocks(h, ends, np.empty(0, np.uint64))
    got = np.concatenate([np.arange(b, b + n) for b, n in zip(begin, windows, strict=True)])
    sizes = np.diff(np.r_[0, ends])
    want = np.concatenate([np.arange(e - s, e - 19) for e, s in zip(ends, sizes, strict=True) if s >= 20])
    assert (got == want).all()
    assert [list(x) for x in joined_spans(np.array([5, 0, 30]), np.array([9, 6, 40]))] == [[0, 30], [9, 40]]
