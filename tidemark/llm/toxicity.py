"""Toxicity of texts that are written to evade word lists: a noisy-channel decoder, then a model.

**Language model.** Letter trigrams of all words of the corpus, counted by Spark over every occurrence
in every document, so files and batches do not matter. Letters count without their accents; the alphabet
is a to z and the word border, which bounds the table.

**Channel.** A token that is not plain letters, or has two equal letters in a row, becomes a lattice: a
symbol may stand for a letter it looks like, a masked place for any letter or none, a separator for
nothing, a run of equal letters for one or two, and any other character for itself; single letters in a
row are one spaced-out word. Viterbi over the last two letters finds the likeliest word under channel and
language model. The token as it stands competes with that word, at a price per digit, letter, other
character and change between them, so numbers stay numbers. A token with masked places also
counts as it is written, and only so if half of it is masked. Plain tokens are themselves, without accents.

**Bounds.** A lattice has at most ``MOST_RUNS`` runs of equal characters, however long each, and
``MOST_MASKS`` masked places; a token beyond is no disguised word and stays as it is.

**Score.** A logistic model over how often the restored text has each of the words that tell labels
apart best. Words are chosen, and weights are learned, on at most ``LABELLED`` labelled documents that
are not held out; the language model reads everything.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    group_of,
    id_and_text,
    ids,
    map_texts,
    stored,
    texts,
    words_of,
)

LABELLED = 20_000
CHOSEN_WORDS = 256
FOLDS, HELD_OUT = 5, 0
MOST_RUNS, MOST_MASKS = 64, 6
MEMORY_WORDS = 500_000
MOST_RUNS_KNOWN = 10_000
STEPS, RATE, RIDGE = 400, 1.0, 1e-4

BORDER = "^"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Letters that a character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_~'`·"
MASKS = "*#%?&"
COST_LOOK, COST_SKIP, COST_MASK, COST_NO_LETTER, COST_RUN, COST_PAIR = 1.0, 0.5, 0.5, 4.0, 1.0, 6.0
COST_FRONT, COST_BACK, COST_OTHER = 9.0, 5.0, 6.0  # a sign before or behind a word that is no part of it
# The token as it stands: per digit, letter and other character, and per change between these.
AS_DIGIT, AS_LETTER, AS_OTHER, AS_CHANGE = math.log(10), math.log(26), 6.0, 8.0

# Equal separators of up to three characters, or one separator of any kind, between single characters.
_SPACED = re.compile(
    rb"(?:(?<=\s)|^)[A-Za-z0-9@$!*](?:([ .*_-]{1,3})[A-Za-z0-9@$!*](?:\1[A-Za-z0-9@$!*])+"
    rb"|(?:[ .*_-][A-Za-z0-9@$!*]){2,})(?=[\s.,!?;:]|$)"
)
_MAYBE_SPACED = re.compile(rb"\s\S[ .*_-]{1,3}\S[ .*_-]{1,3}\S")
_EDGE = ".,;:!?\"'()[]{}<>&%#*~-_|/\\"
# What a word has around it as punctuation; the rest at an edge may be part of it.
_BEFORE, _AFTER = ".,;:?\"'([{<&%#*~-_/\\>)]}", ".,;:!?\"')]}>&%~-_/\\<([{|"
_TWICE = re.compile(r"(.)\1", re.DOTALL)
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
_EDGE_BYTES = _EDGE.encode()
# Trigrams by number: the border is 0, a to z are 1 to 26.
_GRAMS = [a + b + c for a in BORDER + LETTERS for b in BORDER + LETTERS for c in BORDER + LETTERS]
_LETTER_AT = np.zeros(256, np.int64)
_LETTER_AT[list(LETTERS.encode())] = range(1, 27)


class _Bare(dict):
    """Characters by code without accents, where that leaves ASCII or nothing; others stay."""

    def __missing__(self, code: int) -> str:
        apart = unicodedata.normalize("NFKD", chr(code))
        bare = "".join(c for c in apart if not unicodedata.combining(c)).lower()
        self[code] = bare = bare if bare.isascii() else chr(code)
        return bare


_BARE = _Bare()


def folded(text: str) -> str:
    """Lower case without accents and compatibility forms."""
    text = text.lower()
    if text.isascii():
        return text
    bare = text.translate(_BARE)
    if bare.isascii():
        return bare
    apart = unicodedata.normalize("NFKD", text)
    bare = "".join(c for c in apart if not unicodedata.combining(c))
    return unicodedata.normalize("NFC", bare).lower()


def count_letters(docs: DataFrame) -> DataFrame:
    """``gram`` (three letters, ``^`` for the border) and ``n`` over the words of all documents."""

    def rows(batch) -> Iterator[dict]:
        seen: Counter[bytes] = Counter()
        for text in texts(batch):
            seen.update(words_of(text))
        words: Counter[bytes] = Counter()
        for token, n in seen.items():
            word = token.lower() if token.isascii() else folded(token.decode()).encode()
            word = word.strip(_EDGE_BYTES)
            if word.isalpha():  # of bytes: a to z only
                words[word] += n
        counts = trigram_counts(words)
        found = np.flatnonzero(counts)
        yield {"gram": [_GRAMS[k] for k in found.tolist()], "n": counts[found]}

    per_batch = map_texts(id_and_text(docs), "gram string, n bigint", rows)
    return per_batch.groupBy("gram").agg(F.sum("n").alias("n"))


def trigram_counts(words: dict[bytes, int]) -> np.ndarray:
    """How often each trigram of ``_GRAMS`` occurs in words of a to z that occur so often."""
    padded = b"".join([b"^^%b^" % word for word in words])
    at = _LETTER_AT[np.frombuffer(padded, np.uint8)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 3
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), lengths)
    last = np.cumsum(lengths) - 1
    times[last] = times[last - 1] = 0  # what starts there reaches into the next word
    grams = (at[:-2] * 27 + at[1:-1]) * 27 + at[2:]
    counts = np.zeros(27**3, np.int64)
    np.add.at(counts, grams, times[: len(grams)])
    return counts


class Decoder:
    """Most likely plain word of a token, by Viterbi over trigram states."""

    def __init__(self, grams: dict[str, int]):
        contexts: Counter[str] = Counter()
        for gram, n in grams.items():
            contexts[gram[:2]] += n
        self.cost = {
            gram: -math.log((n + 0.1) / (contexts[gram[:2]] + 2.7)) for gram, n in grams.items()
        }
        self.unseen = {c: -math.log(0.1 / (n + 2.7)) for c, n in contexts.items()}
        self.nothing = -math.log(0.1 / 2.7)
        self.known: dict[str, list[list[tuple[str, float]]]] = {}

    def __reduce__(self):
        return _decoder_of, (self.cost, self.unseen)

    def step(self, state: str, letter: str) -> float:
        found = self.cost.get(state + letter)
        return found if found is not None else self.unseen.get(state, self.nothing)

    def slots(self, token: str) -> list[list[tuple[str, float]]]:
        """Per run of equal characters, or masked place: what it may stand for, and the channel's cost."""
        slots = []
        for run in _RUNS.finditer(token):
            text = run[0]
            found = self.known.get(text)
            if found is None:
                found = run_slots(text)
                if len(text) <= 2 and len(self.known) < MOST_RUNS_KNOWN:
                    self.known[text] = found
            slots += found
        for place, cost in ((0, COST_FRONT), (-1, COST_BACK)) if len(slots) > 1 else ():
            if not token[place].isalpha() and all(word for word, _ in slots[place]):
                slots[place] = [*slots[place], ("", cost)]
        return slots

    def reading(self, token: str, limit: float = math.inf) -> tuple[float, str] | None:
        """The likeliest word with its cost, or None if every word costs more than ``limit``."""
        known, unseen, nothing = self.cost.get, self.unseen.get, self.nothing
        slots = self.slots(token)
        at, total, word, plain = BORDER * 2, 0.0, "", 0
        while plain < len(slots) and len(slots[plain]) == 1:  # nothing to choose before the first of these
            letters, channel = slots[plain][0]
            total += channel
            for letter in letters:
                gram = at + letter
                step = known(gram)
                total += unseen(at, nothing) if step is None else step
                at = gram[1:]
            word, plain = word + letters, plain + 1
        if total > limit:
            return None
        best = {at: (total, word)}
        for options in slots[plain:]:
            after: dict[str, tuple[float, str]] = {}
            for state, (cost, word) in best.items():
                for letters, channel in options:
                    at, total = state, cost + channel
                    for letter in letters:
                        gram = at + letter
                        step = known(gram)
                        total += unseen(at, nothing) if step is None else step
                        at = gram[1:]
                    if total <= limit:
                        there = after.get(at)
                        if there is None or (total, word + letters) < there:
                            after[at] = (total, word + letters)
            best = after
        cost, word = min(
            ((c + self.step(s, BORDER), w) for s, (c, w) in best.items()), default=(math.inf, "")
        )
        return (cost, word) if cost <= limit and cost < math.inf else None

    def decode(self, token: str) -> str:
        """The likeliest word, whatever it costs."""
        return self.reading(token)[1]


def _decoder_of(cost: dict[str, float], unseen: dict[str, float]) -> Decoder:
    decoder = Decoder({})
    decoder.cost, decoder.unseen = cost, unseen
    return decoder


def run_slots(run: str) -> list[list[tuple[str, float]]]:
    """What a run of equal characters may stand for, and the channel's cost: a slot, or one per mask."""
    char, n = run[0], len(run)
    if char in MASKS:
        return [[("", COST_NO_LETTER)] + [(c, COST_MASK) for c in LETTERS]] * n
    if char in LETTERS:
        options = [(char * min(n, 2), 0.0 if n <= 2 else COST_RUN)]
        if n > 1:
            options.append((char, COST_PAIR if n == 2 else COST_RUN))
        return [options]
    if char in SEPARATORS:
        return [[("", COST_SKIP)]]
    if char in LOOKS_LIKE:
        return [[(c * m, COST_LOOK) for c in LOOKS_LIKE[char] for m in {1, min(n, 2)}]]
    return [[(char * n, 0.0 if char.isalpha() else COST_OTHER)]]


def as_it_stands(token: str) -> float:
    """What it costs to take a token for no word at all."""
    cost, before = 0.0, None
    for char in token:
        kind = AS_DIGIT if char.isdigit() else AS_LETTER if char.isalpha() else AS_OTHER
        cost += kind + (AS_CHANGE if before not in (None, kind) else 0.0)
        before = kind
    return cost


def core_of(text: str) -> str:
    """A token without the punctuation around it.

    Masks behind a word belong to it, unless they stand before it too or behind four letters and
    more, where they hide nothing that the word's beginning does not tell.
    """
    core = text.lstrip(_BEFORE)
    before = text[: len(text) - len(core)]
    end = core.rstrip(_AFTER)
    unmasked = end.rstrip("*#")
    masks = end[len(unmasked) :]
    stem = unmasked.rstrip(_AFTER)
    if masks and masks[-1] not in before and stem == unmasked and not (stem[-4:].isalpha() and stem[3:]):
        return end
    return stem


class Restorer(dict):
    """Restored words by token, remembered up to ``MEMORY_WORDS`` tokens."""

    def __init__(self, decoder: Decoder):
        super().__init__()
        self.decoder = decoder

    def restored(self, token: str) -> str:
        text = folded(token)
        core = text.lstrip(_BEFORE).rstrip(_AFTER)
        if not core.isalpha():
            core = core_of(text)
        if core.isalpha():
            several = _TWICE.search(core) and sum(1 for _ in _RUNS.finditer(core)) <= MOST_RUNS
            return self.decoder.decode(core) if several else core
        places = sum(map(core.count, MASKS))
        if places > MOST_MASKS or 2 * places >= len(core) or sum(1 for _ in groupby(core)) > MOST_RUNS:
            return core
        found = self.decoder.reading(core, as_it_stands(core)) if core else None
        return found[1] if found else core

    def __missing__(self, token: bytes) -> str:
        word = self.restored(token.decode())
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[token] = word
        return word

    def __reduce__(self):
        return Restorer, (self.decoder,)


def masked(token: bytes) -> tuple[str, ...]:
    """A token with masked places, as it is written: no reading of it is sure."""
    if b"*" not in token and b"#" not in token:
        return ()
    core = core_of(folded(token.decode()))
    return (core,) if "*" in core or "#" in core else ()


def joined_letters(text: bytes) -> list[bytes]:
    """Words that are written letter by letter, joined."""
    if not _MAYBE_SPACED.search(b" " + text):
        return []
    return [re.sub(rb"[ .*_-]", b"", m[0]) for m in _SPACED.finditer(text)]


def keys_of(word: str) -> tuple[str, ...]:
    """The word itself and, for inflected forms, its beginning."""
    return (word, f"{word[:4]}~") if len(word) > 4 else (word,)


class KeyIndex(dict):
    """Which chosen keys a token has; most tokens have none, which is remembered as well."""

    def __init__(self, words: list[str], restorer: Restorer):
        super().__init__()
        self.words, self.restorer = words, restorer
        self.position = {w: k for k, w in enumerate(words)}

    def __missing__(self, token: bytes) -> tuple[int, ...]:
        found = keys_of(self.restorer.restored(token.decode())) + masked(token)
        at = tuple(self.position[w] for w in found if w in self.position)
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[token] = at
        return at

    def __reduce__(self):
        return KeyIndex, (self.words, self.restorer)

    def row(self, text: bytes) -> list[tuple[int, float]]:
        """How often the restored text has each chosen key, as logarithms."""
        tokens = words_of(text) + joined_letters(text)
        counts = Counter(k for at in filter(None, map(self.__getitem__, tokens)) for k in at)
        return [(k, math.log1p(n)) for k, n in sorted(counts.items())]


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, row: list[tuple[int, float]]) -> float:
        total = self.bias + sum(self.weights[k] * v for k, v in row)
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, total))))


def choose_words(sample: DataFrame, restorer: Restorer) -> list[str]:
    """Words and beginnings that occur in more toxic than clean documents, by information about the label."""

    def rows(batch) -> Iterator[dict]:
        marks = batch.column("toxic").to_pylist()
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, mark in zip(texts(batch), marks, strict=True):
            tokens = {*words_of(text), *joined_letters(text)}
            seen[mark].update({k for t in tokens for k in keys_of(restorer[t]) + masked(t)})
        words = list(seen[0].keys() | seen[1].keys())
        yield {
            "word": words,
            "toxic": [seen[1][w] for w in words],
            "clean": [seen[0][w] for w in words],
        }

    counts = map_texts(sample, "word string, toxic bigint, clean bigint", rows)
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return []
    ratio = F.log(((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1)))
    telling = counts.filter("a >= 3").withColumn("gain", F.col("a") * ratio).filter("gain > 0")
    best = telling.orderBy(F.desc("gain"), "word").limit(CHOSEN_WORDS)
    return [r.word for r in best.collect()]


def fit(rows: list[list[tuple[int, float]]], toxic: np.ndarray, words: list[str]) -> ToxicityModel:
    """Logistic regression by gradient steps; weights of these words are kept at zero or above."""
    share = float(np.clip(toxic.mean() if len(toxic) else 0.0, 1e-3, 1 - 1e-3))
    weights, bias = np.zeros(len(words)), math.log(share / (1 - share))
    x = np.zeros((len(rows), len(words)), np.float32)
    for i, row in enumerate(rows):
        for k, v in row:
            x[i, k] = v
    pace, pace_bias = np.zeros(len(words)), 0.0
    for _ in range(STEPS if words else 0):
        wrong = toxic - 1.0 / (1.0 + np.exp(-np.clip(x @ weights + bias, -30, 30)))
        balance = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
        wrong = wrong * balance
        pace = 0.9 * pace + wrong @ x / len(rows) - RIDGE * weights
        pace_bias = 0.9 * pace_bias + wrong.mean()
        weights = np.maximum(weights + RATE * pace, 0.0)
        bias += RATE * pace_bias
    return ToxicityModel(weights, bias)


def learn(
    docs: DataFrame, labels: DataFrame, restorer: Restorer
) -> tuple[KeyIndex, ToxicityModel]:
    """Chosen keys and their weights, from a bounded sample of labelled documents."""
    usable = labels.select("doc_id", "toxic").filter(
        F.col("toxic").isin(0, 1)
        & F.col("doc_id").isNotNull()
        & (group_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(LABELLED)
    sample = stored(id_and_text(docs).join(chosen, "doc_id"), "toxicity-sample")
    words = choose_words(sample, restorer)
    index = KeyIndex(words, restorer)

    def rows(batch) -> Iterator[dict]:
        found = [index.row(t) for t in texts(batch)]
        yield {
            "doc_id": ids(batch),
            "toxic": batch.column("toxic"),
            "at": [[k for k, _ in row] for row in found],
            "value": [[v for _, v in row] for row in found],
        }

    seen = map_texts(sample, "doc_id bigint, toxic int, at array<int>, value array<double>", rows)
    seen = seen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(LABELLED).toPandas()
    pairs = [list(zip(a, v, strict=True)) for a, v in zip(seen["at"], seen["value"], strict=True)]
    return index, fit(pairs, seen["toxic"].to_numpy(), words)


def letter_model(docs: DataFrame) -> Decoder:
    """The channel's decoder with the corpus's letter trigrams, at most 27 cubed of them."""
    return Decoder({r.gram: r.n for r in count_letters(docs).collect()})


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score in 0 to 1, predicted (1 if score >= 0.5); one row per input row.

    Learns from ``labels`` (doc_id, toxic) but never from rows whose group is held out. NULL and
    empty texts get the score of a text without telling words. A NULL doc_id is scored and not held
    out. Without both kinds of labels every document has the same score below 0.5.
    """
    restorer = Restorer(letter_model(docs))
    index, model = learn(docs, labels, restorer)

    def rows(batch) -> Iterator[dict]:
        scores = [model.score(index.row(t)) for t in texts(batch)]
        yield {"doc_id": ids(batch), "score": scores}

    scored = map_texts(id_and_text(docs), "doc_id bigint, score double", rows)
    held_out = F.coalesce(group_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
