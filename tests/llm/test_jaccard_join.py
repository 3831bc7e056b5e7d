"""Groups against brute force over all pairs; odd rows; long lists."""

import random
import re

import numpy as np
import pytest
from conftest import SF_DIR

from tidemark.llm import jaccard_join
from tidemark.llm.common import documents
from tidemark.llm.jaccard_join import one_of_each_group, similar_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """rows: (doc_id, text). doc_id -> (set size, component)."""
    sets = {d: shingles(t) for d, t in rows}
    at = {d: d for d in sets}

    def root(d):
        while at[d] != d:
            d = at[d]
        return d

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                one, other = sorted((root(a), root(b)))
                at[other] = one
    return {d: (len(sets[d]), root(d)) for d in sets}


def check(spark, rows, **order):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(docs, **order).collect()}
    assert got == brute(rows)


def test_whole_table(spark):
    check(spark, [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()])


@pytest.mark.parametrize("seed,common", [(1, 3), (2, 1), (3, 3)])
def test_chains_of_near_copies_and_shared_passages(spark, seed, common):
    """Many texts near the threshold, sharing passages, with frequent shingles last or not."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for _ in range(12):
        text = rng.choices(vocabulary, k=rng.choice([3, 5, 6, 9, 30, 80]))
        for _ in range(rng.choice([1, 3, 9])):
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: max(1, len(text) - rng.choice([1, 5]))]
            shown = text + passage if rng.random() < 0.4 else text
            rows.append((len(rows) * 7 % 1009, " ".join(shown)))
    check(spark, rows, sampled=2, least=common)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            text[rng.randrange(60)] = f"x{rng.random()}"
        rows.append((i, " ".join(text)))
    check(spark, rows)


def test_odd_rows(spark):
    text = "one two three four five six seven"
    odd = [(None, text, 1), (5, text.upper(), 2), (4, text, 3), (4, text, 3), (6, None, 4), (7, "", 5)]
    odd += [(8, " \n", 6), (9, "short", 7), (10, "SHORT ", 8), (11, "çÉ", 9), (12, "çé", 9)]
    odd += [(13, "long " * 30_000, None), (14, "long " * 5, None)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, n_shingles int")
    got = sorted(map(tuple, similar_groups(docs).collect()), key=repr)
    want = [(None, 3, None), (5, 3, 4), (4, 3, 4), (4, 3, 4), (6, 0, 6), (7, 0, 7), (8, 0, 8)]
    want += [(9, 1, 9), (10, 1, 9), (11, 1, 11), (12, 1, 12), (13, 1, 13), (14, 1, 13)]
    assert got == sorted(want, key=repr)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [
        11, 12, 13, 4, 4, 6, 7, 8, 9, None
    ]
    assert similar_groups(docs.limit(0)).count() == 0


def test_the_order_does_not_change_what_must_be_shared():
    rng = np.random.default_rng(3)
    for _ in range(300):
        pool = rng.integers(0, 60, 40).astype(np.uint64)
        x, y = np.unique(pool[:30]), np.unique(pool[rng.integers(0, 6) : 34])
        common = np.unique(rng.integers(0, 60, 20).astype(np.uint64))
        inter = len(np.intersect1d(x, y))
        if 100 * inter >= 75 * (len(x) + len(y) - inter):
            a, b = (jaccard_join.in_order(s, common)[0][: jaccard_join.first_part(len(s))] for s in (x, y))
            assert len(np.intersect1d(a, b))


def test_sketches_differ_in_at_most_as_many_bits_as_sets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        x, y = np.unique(pool[: rng.integers(1, 300)]), np.unique(pool[rng.integers(0, 299) :])
        bits = jaccard_join.differing_bits(jaccard_join.sketch(x), jaccard_join.sketch(y))
        assert bits <= len(np.setxor1d(x, y))
        few = [jaccard_join.folded(jaccard_join.sketch(s), 32) for s in (x, y)]
        assert jaccard_join.differing_bits(*few) <= bits
