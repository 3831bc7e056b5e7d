"""Pairs and terms against whole numbers in plain dictionaries; odd rows; small blocks."""

import random
import re
from collections import Counter

import numpy as np
from conftest import SF_DIR

from tidemark.llm import divergence
from tidemark.llm.common import documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "text string, lang string, source string"


def brute(rows):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in here for t in set(terms))
        kept = [t for t, n in seen.items() if n >= 3]
        counts = {s: Counter() for _, s, _ in here}
        for _, source, terms in here:
            counts[source].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), Counter())

        def share(count, of):
            return 1 + 10**9 * (count + 1) // (sum(of.values()) + len(kept))

        for source, own in counts.items():
            pairs = []
            for other, theirs in counts.items():
                f = [(share(own[t], own), share(theirs[t], theirs)) for t in kept]
                if other != source:
                    pairs.append((sum((p - q) ** 2 // q for p, q in f), other))
            over = [(share(n, own), share(whole[t], whole), t) for t, n in own.items() if n]
            terms = [((p - q) ** 2 // q, t) for p, q, t in over if p > q]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found[: None if part == "pair" else 200], 1):
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, divergence.source_divergence(docs).collect()))
    assert got == brute(rows)
    return got


def test_whole_table(spark):
    check(spark, [tuple(r) for r in documents(spark, SF_DIR).select("text", "lang", "source").collect()])


def test_many_small_blocks(spark, monkeypatch):
    """Cells of two sources and about seven terms, so that every axis has several blocks."""
    monkeypatch.setattr(divergence, "GROUP_BLOCK", 2)
    monkeypatch.setattr(divergence, "TERM_BLOCK", 7)
    rng = random.Random(3)
    words = [f"w{'abcdefghij'[i % 10]}{'klmno'[i % 5]}{'é' * (i % 3)}{'xyzuvw'[i % 6]}" for i in range(60)]
    rows = []
    for _ in range(300):
        lang, source = rng.choice("AB"), f"s{rng.randrange(7)}"
        text = " ".join(rng.choices(words, k=rng.randrange(12))) + rng.choice(["", " 12 only3digits", "\n"])
        rows.append((text, lang, "s0" if rng.random() < 0.4 else source))
    check(spark, rows)


def test_odd_rows(spark):
    """NULLs, groups and languages without terms, repeated rows, ties, a very long text."""
    rows = [
        (None, None, None),
        ("", "en", "empty"),
        ("one two", "en", "a"),
        ("One TWO", "en", "a"),
        ("one two Ünder ÜNDER ünder", "en", "b"),
        ("one_two-three4one", "en", None),
        ("İstanbul KELVIN Kelvin", "en", "b"),
        ("alone", "de", "x"),
        ("alone", "de", "y"),
        ("word " * 100_000, "en", "long"),
        ("word", "en", "a"),
        ("word", "en", "b"),
    ]
    got = check(spark, rows + rows[2:4])
    assert ("de", "x", "pair", "y", 0, 1) in got
    assert any(r[1] == "empty" and r[2] == "pair" for r in got)


def test_empty_table_and_further_columns(spark):
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([("a b c", "en", s) for s in "xxyyz"], SCHEMA)
    more = docs
    for name in ("term", "n", "docs", "v", "total", "group_id", "item", "value", "rank", "p", "q"):
        more = more.withColumn(name, divergence.F.lit("x"))
    want = sorted(map(tuple, divergence.source_divergence(docs).collect()))
    assert sorted(map(tuple, divergence.source_divergence(more).collect())) == want


def test_shares_stay_exact_at_any_size(spark):
    """In the cells and in SQL, up to counts far beyond those of the tables."""
    rng = random.Random(5)
    cases = [(c := rng.randrange(10**k), c + rng.randrange(1, 10**k)) for k in range(1, 15) for _ in range(20)]
    want = [1 + 10**9 * (c + 1) // (n + 9) for c, n in cases]
    got = [int(divergence.shares(np.array([[c]]), np.array([n]), 9)[0, 0]) for c, n in cases]
    assert got == want
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, c bigint, n bigint")
    column = divergence._share(divergence.F.col("c"), divergence.F.col("n") + 9)
    assert [r[0] for r in rows.orderBy("i").select(column).collect()] == want


def test_counts_survive_a_full_table(spark, monkeypatch):
    """Counts handed on in many parts are the same counts."""
    rows = [(" ".join(f"t{'abcdef'[j % 6]}{'ghijk'[i % 5]}" for j in range(i)), "en", "s") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    batches = docs.toArrow().to_batches()
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    parts = [tuple(r.values()) for b in divergence._counted(iter(batches)) for r in b.to_pylist()]
    summed = Counter()
    for lang, source, term, n, seen in parts:
        summed[term] += n
    assert +summed == Counter(t for text, _, _ in rows for t in TERM.findall(text))
    assert len(parts) > 30
