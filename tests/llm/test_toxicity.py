"""Decoding by brute force on short tokens, held-out accuracy, disguised words, odd rows."""

import itertools
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR

from tidemark.llm import toxicity
from tidemark.llm.common import documents, labels
from tidemark.llm.toxicity import (
    BORDER,
    Decoder,
    Restorer,
    count_letters,
    joined_letters,
    letter_model,
    toxicity_scores,
)

LARGER = SF_DIR.replace("0.001", "0.01")  # enough labels to learn from
DOCS = "doc_id bigint, text string, score string, word int"


@pytest.fixture(scope="module")
def decoder(spark):
    return letter_model(documents(spark, SF_DIR))


def every_reading(decoder, token):
    for choice in itertools.product(*decoder.slots(token)):
        word = "".join(letters for letters, _ in choice)
        cost, state = sum(c for _, c in choice), BORDER * 2
        for letter in word + BORDER:
            cost += decoder.step(state, letter)
            state = state[1] + letter
        yield cost, word


@pytest.mark.parametrize("token", ["s0", "1n", "th3", "a*e", "be.st", "w|ll", "ssso", "7h1$", "aa4"])
def test_viterbi_equals_all_readings(decoder, token):
    best = min(every_reading(decoder, token))
    found = decoder.decode(token)
    cost = min(c for c, w in every_reading(decoder, token) if w == found)
    assert cost == pytest.approx(best[0])


def test_tokens_without_a_lattice_stay(decoder):
    assert decoder.decode("çé") == "çé"
    assert joined_letters(b"an i d i o t, a b") == [b"idiot"]
    assert joined_letters(b"") == []


@pytest.fixture(scope="module")
def restorer(spark):
    return Restorer(letter_model(documents(spark, LARGER)))


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("5tup1d", "stupid"), ("stuupid", "stupid"), ("$tup!d", "stupid"), ("st" + "u" * 60 + "pid", "stupid"),
        ("m\u00f6r\u00f6n1", "moron"), ("m\u00f6r\u00f6n", "moron"), ("scum!!", "scum"), ("(scum)", "scum"), ("s.c.u.m", "scum"),
        ("**scum**", "scum"), ("scum***", "scum"), ("f***", "f***"), ("1234", "1234"), ("2019", "2019"),
        ("7", "7"), ("\u8c22\u8c22", "\u8c22\u8c22"), ("", ""), ("***", ""), ("scum", "scum"),
    ],
)
def test_words_behind_disguises(restorer, token, word):
    assert restorer[token.encode()] == word


def test_tokens_beyond_the_bounds_stay(restorer):
    for token in ("ab1" * 40_000, "a*b*c*d*e*f*g*h"):
        assert restorer[token.encode()] == token


def test_a_token_of_digits_and_one_letter_is_read(restorer):
    assert [restorer[t] for t in (b"1d10t", b"1d107", b"!diot")] == ["idiot"] * 3
    assert restorer[b"@$$"] != "@$$"


def test_letters_by_equal_separators():
    assert joined_letters(b"you  i  d  i  o  t") == [b"idiot"]
    assert joined_letters(b"y o u  i d i o t") == [b"you", b"idiot"]
    assert joined_letters(b"so i.d-i o_t!") == [b"idiot"]


def test_letters_do_not_depend_on_files(spark):
    docs = documents(spark, SF_DIR)
    counts = [
        {r.gram: r.n for r in count_letters(d).collect()}
        for d in (docs.coalesce(1), docs.repartition(7))
    ]
    assert counts[0] == counts[1]


def test_held_out_accuracy_and_disguise(spark):
    docs, marks = documents(spark, LARGER), labels(spark, LARGER)
    disguised = spark.createDataFrame(
        [
            (900_000, "you are an 1d10t and a m0r0n", None),
            (900_001, "what a w0rthless p4thetic s.c.u.m", None),
            (900_002, "such a st.u.pid and disguuusting cl0wn", None),
            (900_003, "the thing of the on is at there 1234 and a 5 by 7", None),
        ],
        "doc_id bigint, text string, lang string",
    )
    rows = toxicity_scores(docs.select("doc_id", "text", "lang").union(disguised), marks).collect()
    truth = {r.doc_id: r.toxic for r in marks.collect()}
    found = {r.doc_id: r for r in rows}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) >= 0.85
    clean = [found[d].predicted for d, t in truth.items() if t == 0]
    assert np.mean(clean) <= 0.05
    assert found[900_003].predicted == 0
    assert [found[900_000 + i].predicted for i in range(3)] == [1, 1, 1]
    toxic = [p for p, t in held if t == 1]
    assert sum(toxic) >= len(toxic) - 1  # one of them has no toxic word at all
    caught = [found[d].predicted for d, t in truth.items() if t == 1]
    assert np.mean(caught) >= 0.9


def test_held_out_labels_are_not_read(spark):
    docs, marks = documents(spark, SF_DIR), labels(spark, SF_DIR)
    turned = marks.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic"
    )
    first = {r.doc_id: r.score for r in toxicity_scores(docs, marks).collect()}
    assert first == {r.doc_id: r.score for r in toxicity_scores(docs, turned).collect()}


def test_odd_rows(spark):
    odd = [(None, "a b c", None, 1), (1, None, "x", None), (2, "", None, None), (3, " \n ", None, 2)]
    odd += [(4, "bad word", None, None)] * 2 + [(5, "x" * 100_000 + " $" * 9, None, None)]
    docs = spark.createDataFrame(odd, DOCS)
    marks = spark.createDataFrame(
        [(4, 1, 1), (5, 0, 0), (None, 1, 1), (2, 1, None)], "doc_id bigint, quality int, toxic int"
    )
    rows = toxicity_scores(docs, marks).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == 0 for r in toxicity_scores(docs, marks.limit(0)).collect())
    assert toxicity_scores(docs.limit(0), marks).count() == 0


def test_letters_are_counted_as_one_by_one():
    words = {b"a": 3, b"letter": 2, b"zz": 1, b"abracadabra": 7}
    plain = Counter()
    for word, n in words.items():
        padded = f"{BORDER}{BORDER}{word.decode()}{BORDER}"
        for i in range(len(word) + 1):
            plain[padded[i : i + 3]] += n
    found = toxicity.trigram_counts(words)
    assert {toxicity._GRAMS[k]: int(found[k]) for k in np.flatnonzero(found)} == plain
    assert not toxicity.trigram_counts({}).any()


def test_words_with_punctuation_take_the_short_way(decoder, monkeypatch):
    monkeypatch.setattr(toxicity, "core_of", lambda *a: pytest.fail("stripped again"))
    tokens = ["Scum", "(scum),", "M\u00f6ron.", "stuupid!", "ab" * 80 + "c"]
    restorer = Restorer(decoder)
    assert [restorer[t.encode()] for t in tokens[:3]] == ["scum", "scum", "moron"]
    assert restorer[tokens[3].encode()] == restorer.decoder.decode("stuupid")
    assert restorer[tokens[4].encode()] == tokens[4]


def test_folding_by_table_equals_folding_the_text():
    def plainly(text):
        bare = (c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
        return unicodedata.normalize("NFC", "".join(bare)).lower()

    every = [chr(c) for c in range(0x3000)] + ["\u212a", "\ufb01", "\uac00", "\u1100\u1161", "\u2460"]
    for c in every:
        for text in (c, f"a{c}\u0301b", f"\u00e9{c}", f"{c}\u03a3"):
            assert toxicity.folded(text) == plainly(text)
