"""Counts against brute force, bands, odd rows."""

import random
import re
from collections import Counter

import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.common import documents, labels, word_hashes, words_of
from tidemark.llm.fertility import bands, measured, quality_rules, repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    n, repeated = len(words), len(covered)
    failed = n < 20 or 100 * repeated > 30 * n
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, doubled, repeated, failed


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF_DIR).collect()}
    rows = quality_rules(documents(spark, SF_DIR)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    good = {r.doc_id for r in labels(spark, SF_DIR).collect() if r.quality == 1}
    judged = [r.kept for r in rows if r.doc_id in good and not r.base_failed]
    assert all(judged)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert repeated_words(word_hashes([w.encode() for w in words])) == brute(" ".join(words))[4]


def test_strange_text_falls_outside_its_language(spark):
    docs = documents(spark, SF_DIR).select("doc_id", "text", "lang")
    plain = " ".join(f"{a}{b}" for a in "bcdfghjk" for b in ("at", "en", "it", "ox", "up", "ar", "im"))
    rare = " ".join(chr(0x12000 + i) + chr(0x1F600 + i % 60) for i in range(60))
    more = [(10_000 + i, plain, "xx") for i in range(9)] + [(10_100, rare, "xx")]
    both = docs.union(spark.createDataFrame(more, docs.schema))
    rows = {r.doc_id: r for r in quality_rules(both).collect()}
    assert rows[10_100].base_failed is False and rows[10_100].kept is False
    assert all(rows[10_000 + i].kept for i in range(9))
    assert "xx" in {r.band_lang for r in bands(measured(both)).collect()}


@pytest.mark.parametrize("with_lang", [True, False])
def test_odd_rows(spark, with_lang):
    text = " ".join(f"w{i}" for i in range(30))
    odd = [(None, text, None, 1), (1, None, "en", 2), (2, "", None, 3), (3, text, "en", 4), (3, text, "en", 4)]
    odd += [(4, "x" * 100_000, "", None), (5, "a\x1cb\u00a0c \u0085 d", "en", None)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, lang string, kept int")
    docs = docs if with_lang else docs.drop("lang")
    rows = quality_rules(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.kept) for r in rows))) == sorted(
        map(repr, [(None, 30, True), (1, 0, False), (2, 0, False), (3, 30, True), (3, 30, True),
                   (4, 1, False), (5, 3, False)])
    )
    assert quality_rules(docs.limit(0)).count() == 0


LARGER = "/root/testdata/sf0.01"
SPAM = ["cheap", "pills", "casino", "free"]


def gibberish(rnd, n):
    return " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(n))


def test_garbage_is_rejected_in_every_language(spark):
    rnd = random.Random(7)
    docs = documents(spark, LARGER).select("doc_id", "text", "lang", "source")
    planted = []
    for lang in ("en", "fr", "de", "es"):
        for n in (100, 300, 1000):
            salad = " ".join(rnd.choices(SPAM, k=n))
            numbers = " ".join(str(rnd.randrange(100_000)) for _ in range(n))
            planted += [(lang, t) for t in (salad, numbers, gibberish(rnd, n))]
    more = [(10**9 + i, t, lang, "src1") for i, (lang, t) in enumerate(planted)]
    rows = quality_rules(docs.union(spark.createDataFrame(more, docs.schema))).collect()
    assert [planted[r.doc_id - 10**9] for r in rows if r.doc_id >= 10**9 and r.kept] == []
    judged = {r.doc_id: r.kept for r in rows if not r.base_failed}
    marks = {r.doc_id: r.quality for r in labels(spark, LARGER).collect()}
    good = [kept for i, kept in judged.items() if marks.get(i) == 1]
    bad = [kept for i, kept in judged.items() if marks.get(i) == 0]
    assert good.count(False) <= len(good) // 50 and bad.count(False) >= len(bad) // 2


def test_one_hot_source_does_not_move_the_bands(spark):
    rnd = random.Random(8)
    docs = documents(spark, LARGER).select("doc_id", "text", "lang", "source").filter("lang = 'en'")
    more = [(10**9 + i, gibberish(rnd, 200), "en", "hot") for i in range(docs.count())]
    rows = quality_rules(docs.union(spark.createDataFrame(more, docs.schema))).collect()
    assert not any(r.kept for r in rows if r.doc_id >= 10**9)
    rest = [r.kept for r in rows if r.doc_id < 10**9 and not r.base_failed]
    assert rest.count(True) > 0.9 * len(rest)
