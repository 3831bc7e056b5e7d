"""Dropped lines against edit distances of all pairs of lines; odd rows."""

import random
import re

import pytest
from conftest import SF_DIR

from tidemark.llm.common import documents
from tidemark.llm.line_dedup import without_repeated_lines

# The rule, stated once more: equal lines with a word; a word's difference from this many words on.
NEAR_WORDS = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def within_one(x, y):
    """At most one word put in, left out or replaced."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return x[i:] == y[i + 1 :] or x[i + 1 :] == y[i + 1 :]


def brute(rows):
    """doc_id -> text without the lines that stand earlier."""
    earlier, out = [], {}
    by_size = {}
    for doc_id, text in sorted(r for r in rows if r[1] is not None):
        left = []
        for line in text.split("\n"):
            words = tuple(WORD.findall(line))
            n = len(words)
            same = n >= 1 and words in by_size.get(n, ())
            near = n >= NEAR_WORDS and any(
                within_one(words, other)
                for m in (n - 1, n, n + 1)
                if min(m, n) >= NEAR_WORDS
                for other in by_size.get(m, ())
            )
            if not (same or near):
                left.append(line)
            by_size.setdefault(n, set()).add(words)
            earlier.append(words)
        out[doc_id] = "\n".join(left)
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    assert got == brute(rows)


def test_whole_table(spark):
    docs = documents(spark, SF_DIR)
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])
    changed = without_repeated_lines(docs)
    assert changed.dtypes == docs.dtypes
    assert all(r.n_chars == len(r.text) for r in changed.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_edits_everywhere(spark, seed):
    """Few different words, so that edits fall on runs of equal words, first and last words."""
    rng = random.Random(seed)
    lines = []
    for _ in range(12):
        base = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.choice([3, 7, 8, 9, 12, 20]))]
        for _ in range(8):
            line = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.randrange(len(line) + 1)
                kind = rng.choice("idr")
                if kind == "i":
                    line.insert(at, rng.choice("abz"))
                elif line and at < len(line):
                    line[at : at + 1] = [] if kind == "d" else [rng.choice("abz")]
            lines.append(rng.choice([" ", "  ", "\t"]).join(line))
    rng.shuffle(lines)
    check(spark, [(100 - i, "\n".join(lines[i * 8 : i * 8 + 8])) for i in range(12)])


def test_one_template_line_with_many_fillings(spark):
    rows = [(i, f"this is the line number {i} of a very common template") for i in range(300)]
    check(spark, rows)


def test_odd_rows(spark):
    line = "one two three four five six seven eight"
    odd = [(None, line, "a", 1), (1, None, None, 2), (2, "", "b", None), (3, f"{line}\n{line}", "c", 3)]
    odd += [(4, f"x\n{line} nine\ny\n", "d", 4), (4, f"x\n{line} nine\ny\n", "d", 4), (5, "\n\n \n", "e", 5)]
    odd += [(6, "w " * 20_000, "f", 6)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, line string, h int")
    rows = without_repeated_lines(docs)
    assert rows.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in rows.collect()), key=repr)
    want = [(None, line), (1, None), (2, ""), (3, line), (4, "x\ny\n"), (4, "x\ny\n")]
    want += [(5, "\n\n \n"), (6, "w " * 20_000)]
    assert got == sorted(want, key=repr)
    assert without_repeated_lines(docs.limit(0)).count() == 0


def test_short_lines_go_as_well(spark):
    check(spark, [(1, "Read more\nfirst text"), (2, "second\n Read  more\n\n"), (3, "More\nRead\nmore"), (4, "more\n")])


def test_columns_with_names_of_the_operator(spark):
    rows = [(1, "a line", 3, "x"), (2, "a line\nb", 4, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone int, _gone string")
    out = without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "a line", 3, "x"), (2, "b", 4, "y")]
