"""Quality rules by tokeniser fertility.

Two public vocabularies measure every text word by word: characters per token (byte-level BPE), how many
byte pieces a vocabulary with byte fallback needs for characters it does not have, as a share of the
tokens, and the entropy of the text's own token distribution relative to the
greatest possible one. That entropy falls with a text's length in any language, so it is judged by its
distance from what texts of that length usually have (`usual_entropy`).

What is usual differs by language, so the rejection bands are taken per language over all documents: a
centre, and on both sides ``REACH`` times the median distance from it (7 of these are quartiles widened
by 3 interquartile ranges), at least a margin. A short text's figures scatter more than a long one's, so
distances are compared after scaling by `steadiness`. Centre, distance and usual entropy are medians over
sources of medians per source: one source moves them no further than any other does, however many
documents it has. A language of fewer than ``FEW`` judged documents has wide margins, since its own
scatter is not known. Texts of fewer than ``ENOUGH`` tokens are too short to judge and keep the base verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import beside, ids, map_texts, stored, texts, window_hashes, word_hashes, words_of

SUBWORDS, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEWEST_WORDS, MOST_REPEATED = 20, 30
ENOUGH = 50
REACH = 7.0
FEW = 20
# Beyond so many tokens a text's own subject outweighs the scatter of its tokens.
STEADY = 2_000
ACCURACY = 10_000
MEMORY_WORDS = 800_000
BYTE_PIECE = 0xFFFFFFFF
UNKNOWN_LANGUAGE = "und"
# Bands never come closer to the centre than this: in a language with documents enough, and in one without.
MARGINS = {
    "chars_per_token": (0.1, 0.5),
    "byte_share": (0.05, 0.05),
    "token_entropy": (0.03, 0.1),
}

MEASURED = (
    "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, n_tokens bigint, chars_per_token double, "
    "byte_share double, token_entropy double"
)


class WordTokens(dict):
    """Per word the ids of its subword tokens, and one `BYTE_PIECE` for each byte piece it needs.

    Letters and a tail of plain punctuation are measured apart, which keeps the table small; it is
    emptied when it has ``MEMORY_WORDS`` entries.
    """

    PLAIN_TAIL = b".,!?*&$%#|;:()"

    def __init__(self, subwords: str, pieces: str):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        super().__init__()
        found = [p if p.startswith("/") else public_tokenizers.path(p) for p in (subwords, pieces)]
        self.subwords = Tokenizer.from_file(found[0])
        self.subwords.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=found[1])
        self.is_byte = np.array(
            [self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())], bool
        )

    def __missing__(self, word: bytes) -> bytes:
        head = word.rstrip(self.PLAIN_TAIL)
        if head and head != word and head[-1:].isalnum():
            found = self[head] + self[word[len(head) :]]
        else:
            text = word.decode()
            encoded = self.subwords.encode(text, add_special_tokens=False).ids
            byte_pieces = int(self.is_byte[self.pieces.encode(text)].sum())
            found = np.array(encoded + [BYTE_PIECE] * byte_pieces, "<u4").tobytes()
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = found
        return found


_word_tokens: dict[tuple[str, str], WordTokens] = {}


def _vocabularies(subwords: str, pieces: str) -> WordTokens:
    if (subwords, pieces) not in _word_tokens:
        _word_tokens[subwords, pieces] = WordTokens(subwords, pieces)
    return _word_tokens[subwords, pieces]


def repeated_words(hashes: np.ndarray, size: int = WINDOW) -> int:
    """Words inside a window of ``size`` words that the text has at least twice."""
    windows = window_hashes(hashes, size)
    if len(windows) < 2:
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def code_points(text: bytes) -> int:
    """Characters of UTF-8 text: all bytes but continuation bytes."""
    raw = np.frombuffer(text, np.uint8)
    return int(((raw & 0xC0) != 0x80).sum())


def measures(text: bytes, vocabularies: WordTokens) -> tuple:
    """The counts and the three fertility figures of one text."""
    words = words_of(text)
    tokens = np.frombuffer(b"".join(map(vocabularies.__getitem__, words)), "<u4")
    is_byte = tokens == BYTE_PIECE
    byte_pieces = int(is_byte.sum())
    tokens = tokens[~is_byte] if byte_pieces else tokens
    chars = code_points(b"".join(words))
    entropy = 0.0
    if len(tokens) > 1:
        _, counts = np.unique(tokens, return_counts=True)
        p = counts / len(tokens)
        entropy = float(-(p * np.log(p)).sum() / np.log(len(tokens)))
    return (
        len(words),
        chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        repeated_lines(text),
        repeated_words(word_hashes(words)),
        len(tokens),
        chars / len(tokens) if len(tokens) else 0.0,
        byte_pieces / len(tokens) if len(tokens) else 0.0,
        entropy,
    )


def measured(docs: DataFrame, subwords: str = SUBWORDS, pieces: str = PIECES) -> DataFrame:
    """The measures of every document, in one pass over the texts."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = F.col("source") if "source" in docs.columns else F.lit(None)
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(lang, F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        source.cast("string").alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    names = [part.split()[0] for part in MEASURED.split(", ")][3:]

    def rows(batch) -> Iterator[dict]:
        vocabularies = _vocabularies(subwords, pieces)
        found = [measures(t, vocabularies) for t in texts(batch)]
        columns = list(zip(*found, strict=True)) or [[] for _ in names]
        yield {
            "doc_id": ids(batch),
            "lang": batch.column("lang"),
            "source": batch.column("source"),
            **dict(zip(names, columns, strict=True)),
        }

    return map_texts(read, MEASURED, rows)


def _median(column: str) -> Column:
    return F.percentile_approx(column, 0.5, ACCURACY)


def over_sources(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per key the median over sources of each column's median, and ``n`` rows.

    Medians are approximate with a bounded, mergeable summary, so one key or source may hold any
    share of the rows.
    """
    each = rows.groupBy(key, "source").agg(F.count("*").alias("n"), *[_median(c).alias(c) for c in columns])
    return each.groupBy(key).agg(F.sum("n").alias("n"), *[_median(c).alias(c) for c in columns])


def steadiness() -> Column:
    """What makes distances of texts of different length comparable: a root of tokens that levels off."""
    return F.sqrt(F.col("n_tokens") / (1 + F.col("n_tokens") / STEADY))


def usual_entropy(figures: DataFrame) -> Column:
    """The entropy that texts of ``n_tokens`` usually have, over all languages.

    A line through the medians of texts from each power of two of tokens to the next that has ``FEW``
    of them; the driver sees these medians, at most one for each power.
    """
    length = F.log2(F.greatest("n_tokens", F.lit(1)))
    judged = figures.filter(F.col("n_tokens") >= ENOUGH).select(
        "source", "token_entropy", length.alias("length"), F.floor(length).alias("class")
    )
    found = over_sources(judged, "class", ["length", "token_entropy"]).orderBy("class").collect()
    knots = [(r.length, r.token_entropy) for r in found if r.n >= FEW]
    if len(knots) < 2:
        every = sorted(r.token_entropy for r in found) or [0.0]
        return F.lit(knots[0][1] if knots else every[len(every) // 2])
    line = None
    for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False):
        part = y0 + (length - x0) * ((y1 - y0) / max(x1 - x0, 1e-6))
        line = part if line is None else F.when(length < x0, line).otherwise(part)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), line))


def bands(figures: DataFrame, usual: Column | None = None) -> DataFrame:
    """Per language of each figure the centre and, scaled by `steadiness`, the usual distance from it."""
    usual = usual_entropy(figures) if usual is None else usual
    judged = figures.filter(F.col("n_tokens") >= ENOUGH).select(
        F.col("lang").alias("band_lang"),
        "source",
        "n_tokens",
        *[judged_figure(name, usual).alias(name) for name in MARGINS],
    )
    centres = over_sources(judged, "band_lang", list(MARGINS))
    centres = centres.select("band_lang", "n", *[F.col(c).alias(f"centre_{c}") for c in MARGINS])
    centres = stored(centres, "fertility-centres")
    away = beside(judged, centres, "band_lang").select(
        "band_lang",
        "source",
        *[(F.abs(F.col(c) - F.col(f"centre_{c}")) * steadiness()).alias(f"away_{c}") for c in MARGINS],
    )
    scatter = over_sources(away, "band_lang", [f"away_{c}" for c in MARGINS]).drop("n")
    return stored(centres.join(scatter, "band_lang"), "fertility-bands")


def judged_figure(name: str, usual: Column) -> Column:
    """The figure as it is compared with its band: entropy by its distance from the usual one."""
    return F.col(name) - usual if name == "token_entropy" else F.col(name)


def quality_rules(docs: DataFrame, subwords: str = SUBWORDS, pieces: str = PIECES) -> DataFrame:
    """Counts, base verdict and kept per document; one row per input row.

    ``kept`` is false if the base rules fail, else whether all three figures lie inside the bands of
    the document's language (NULL language and NULL source: one group of their own). NULL and empty texts have no word
    and fail the base rules. Repeated rows and a NULL doc_id are judged like any other.
    """
    figures = stored(measured(docs, subwords, pieces), "fertility")
    base_failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    usual_for_length = usual_entropy(figures)
    inside = F.lit(True)
    for name, (margin, wide) in MARGINS.items():
        reach = F.greatest(
            REACH * F.col(f"away_{name}") / steadiness(), F.when(F.col("n") < FEW, wide).otherwise(margin)
        )
        inside &= F.abs(judged_figure(name, usual_for_length) - F.col(f"centre_{name}")) <= reach
    usual = F.coalesce((F.col("n_tokens") < ENOUGH) | inside, F.lit(True))
    found = bands(figures, usual_for_length)
    rows = beside(figures, found, F.col("lang") == F.col("band_lang"), "left")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & usual).alias("kept"),
        "chars_per_token",
        "byte_share",
        "token_entropy",
    )
