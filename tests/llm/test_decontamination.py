"""Matches against all item-sized windows of all documents; native plan; odd rows."""

import random
import re
from collections import Counter

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tidemark.llm.common import benchmark, documents
from tidemark.llm import decontamination
from tidemark.llm.decontamination import (
    benchmark_items,
    benchmark_matches,
    near_values,
    simhash,
    within_radius,
    without_benchmark,
)


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def shingles(words):
    if not words:
        return Counter()
    if len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs, items):
    found = {}
    for item_id, text in items:
        item = words_of(text)
        want = shingles(item)
        for doc_id, doc_text in docs:
            words = words_of(doc_text)
            if not want or not (set(shingles(words)) & set(want) or len(words) < 5):
                continue
            for start in range(max(1, len(words) - len(item) + 1)):
                have = shingles(words[start : start + len(item)])
                either = sum((have | want).values())
                both = sum((have & want).values())
                if both and 100 * both >= 75 * either:
                    best = found.get((doc_id, item_id), (0, 0))
                    found[doc_id, item_id] = max(best, (both / either, -start))
    return {(d, i, round(v, 9)) for (d, i), (v, _) in found.items()}


def similarity_at(docs, items, row):
    item = words_of(dict(items)[row.item_id])
    have = shingles(words_of(dict(docs)[row.doc_id])[row.start : row.start + len(item)])
    return sum((have & shingles(item)).values()) / sum((have | shingles(item)).values())


def check(spark, docs, items):
    rows = benchmark_matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ).collect()
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in rows}
    assert got == brute(docs, items)
    for r in rows:  # several windows may be equally similar
        assert similarity_at(docs, items, r) == pytest.approx(r.similarity)
    return got


def test_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    items = [(r.item_id, r.text) for r in benchmark(spark, SF_DIR).collect()]
    assert check(spark, docs, items)


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_passages(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([12, 14, 25, 40, 60])))) for i in range(8)]
    docs = []
    for i in range(40):
        passage = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([[], ["X"], [passage[at].upper(), "new"]])
        around = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 30]))) for _ in range(2)]
        docs.append((i, f"{around[0]}\n{' '.join(passage)}\t{around[1]}"))
    assert check(spark, docs, items)


def test_all_fingerprints_within_the_radius_are_found(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    near = []
    for p in prints:
        flips = rng.sample(range(64), rng.choice([0, 1, 8, 14, 15, 16, 20]))
        q = (p & ((1 << 64) - 1)) ^ sum(1 << b for b in flips)
        near.append(q - (1 << 64) if q >> 63 else q)
    windows = spark.createDataFrame(
        [(i, 0, 9, p) for i, p in enumerate(prints)], "doc_id bigint, start int, n_words int, fingerprint bigint"
    )
    items = spark.createDataFrame(
        [(i, 9, p) for i, p in enumerate(near)], "item bigint, n_words int, fingerprint bigint"
    )
    for radius in (15, 0, 7):
        got = {(r.doc_id, r.item) for r in within_radius(windows, items, radius).collect()}
        assert got == within(prints, near, radius)
    assert len(near_values(3)) == 1 + 16 + 120 + 560


def within(prints, near, radius):
    return {
        (i, k)
        for i, p in enumerate(prints)
        for k, q in enumerate(near)
        if bin((p ^ q) & ((1 << 64) - 1)).count("1") <= radius
    }


def test_simhash_is_the_majority(spark):
    rows = spark.createDataFrame([(1, 0b0111), (1, 0b0101), (1, -1), (2, -1)], "k int, h bigint")
    got = {r.k: r.fingerprint for r in simhash(rows, ["k"]).collect()}
    assert got == {1: 0b0111, 2: -1}


def test_no_python_in_the_plan(spark, capsys):
    benchmark_matches(documents(spark, SF_DIR), benchmark(spark, SF_DIR)).explain()
    plan = capsys.readouterr().out
    benchmark_items(benchmark(spark, SF_DIR)).explain()
    plan += capsys.readouterr().out
    for bad in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(None, passage, "a", 1), (1, None, "b", 2), (2, "", "c", 3), (3, f"x {passage} y", "d", 4)]
    docs += [(3, f"x {passage} y", "d", 4), (4, "Short Text", "e", 5), (5, "z " * 50_000, None, None)]
    docs += [(6, f"{passage.upper()} and {passage}", "f", 6)]
    items = [(7, passage), (7, passage), (8, None), (9, ""), (None, passage), (10, "short  text")]
    items += [(11, "short text"), (11, passage)]  # all texts of an item count
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, words string, start int")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    rows = benchmark_matches(docs, items).collect()
    got = sorted(map(tuple, rows), key=repr)
    want = [(3, 7, 1, 1.0), (3, 11, 1, 1.0), (3, None, 1, 1.0), (4, 10, 0, 1.0), (4, 11, 0, 1.0)]
    want += [(6, 7, 0, 1.0), (6, 11, 0, 1.0), (6, None, 0, 1.0)]
    assert got == sorted(want, key=repr)
    assert sorted(map(tuple, benchmark_matches(docs, items, radius=0).collect()), key=repr) == got
    kept = without_benchmark(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 5, None]
    assert benchmark_matches(docs.limit(0), items).count() == 0
    assert benchmark_matches(docs, items.limit(0)).count() == 0
    assert docs.select(F.count("*")).first()[0] == 8


def test_passages_that_break_off_at_the_threshold(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, docs = [], []
    for n in (50, 100, 200, 500):
        for k in range(100):
            item = rng.choices(vocabulary, k=n)
            # a lost tail costs as many shingles as words, a lost middle four more; 1 in 7 is 0.75
            lost = (n - 4) // 7 - (4 if k % 2 else 0)
            at = rng.randrange(5, n - lost - 5) if k % 2 else n - lost
            passage = item[:at] + rng.choices(vocabulary, k=lost) + item[at + lost :]
            around = [rng.choices(vocabulary, k=30) for _ in range(2)]
            docs.append((len(items), " ".join(around[0] + passage + around[1])))
            items.append((len(items), " ".join(item)))
    rows = benchmark_matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in range(len(items))}
    assert min(r.similarity for r in rows) >= 0.75


def matched(spark, docs, items):
    rows = benchmark_matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ).collect()
    return {(r.doc_id, r.item_id) for r in rows}


def shifted(seed):
    """Passages with a word put in or left out in the middle: no place has most of the shingles."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, docs = [], []
    for n in (50, 100, 200, 500):
        for k in range(30):
            item = rng.choices(vocabulary, k=n)
            passage = list(item)
            for _ in range(1 + k % 3):
                at = rng.randrange(n // 3, 2 * n // 3)
                passage[at : at + k % 2] = [] if k % 2 else ["new"]
            docs.append((len(items), " ".join(rng.choices(vocabulary, k=30) + passage + rng.choices(vocabulary, k=30))))
            items.append((len(items), " ".join(item)))
    return docs, items


def test_only_fingerprints_find_shifted_passages(spark, monkeypatch):
    """Recall against brute force with the step, and what is lost without it."""
    docs, items = shifted(9)
    want = {(d, i) for d, i, _ in brute_of_same_number(docs, items)}
    found = matched(spark, docs, items)
    assert found <= want and len(found) >= 0.97 * len(want)
    monkeypatch.setattr(
        decontamination, "within_radius", lambda windows, items, radius: windows.join(items, "n_words").select(
            *windows.drop("fingerprint").columns, "item").limit(0)
    )
    assert len(matched(spark, docs, items)) < 0.5 * len(want)


def brute_of_same_number(docs, items):
    """Brute force of each passage with its own item only; others share no more than chance."""
    return {row for d, i in zip(docs, items) for row in brute([d], [i])}


def test_a_phrase_of_all_items_makes_no_pairs(spark):
    rng = random.Random(2)
    phrase = "as we all know now"
    docs = [(i, " ".join(f"d{rng.randrange(9999)}" for _ in range(40)) + f" {phrase} end") for i in range(400)]
    items = [(i, " ".join(f"i{i}x{k}" for k in range(25)) + f" {phrase} last") for i in range(200)]
    docs_, items_ = (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        benchmark_items(spark.createDataFrame(items, "item_id bigint, text string")),
    )
    placed = decontamination.windows_with_shingles_enough(docs_, decontamination.stored(items_, "t"), 75)
    assert placed.count() == 0
    assert matched(spark, docs, items) == set()


def test_columns_with_names_of_the_operator(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, passage, 1, 2, "x"), (2, "other", 1, 2, "y")],
        "doc_id bigint, text string, _found bigint, item int, start string",
    )
    items = spark.createDataFrame([(7, passage)], "item_id bigint, text string")
    kept = without_benchmark(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "other", 1, 2, "y")]
