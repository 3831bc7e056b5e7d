"""Best-fit packing of token sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The program covers the length
histogram by as few configurations as it can. Multiplicative weights solve it: every length has a
price, a knapsack dynamic program finds the configuration of the greatest total price, that one is
used for a share of what it can serve, and the prices of the lengths it served fall. The fractional
solution is rounded down, what is left is solved again, and the rest is filled best-fit by group of
equal sequences. Pricing also gives a bound from below, and stops where best fit alone meets it; of all
completions the one with the fewest sequences counts. All of that works on the histogram, which has at most ``capacity`` rows, so its
cost does not depend on the number of documents.

Placing is distributed: a piece's rank among the pieces of its length decides its sequence.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, ids, map_texts, stored, texts

CAPACITY = 2048
END_OF_TEXT = 0
VOCABULARY = "word_bpe_49k.json"
ROWS_PER_BUCKET = 20_000
CACHE_WORDS = 400_000
ROUNDS, PRICINGS, SHARE = 2, 256, 0.5
#: From which share of a full sequence on configurations of the program are kept, in turn.
FILLS = (0.0, 0.95, 0.98, 0.99, 0.995, 0.999, 1.0)

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class WordIds(dict):
    """Token ids of words as little-endian 32-bit bytes, found once per Python worker.

    The tokenizer drops white space before it splits, so a text's ids are those of its words in
    order. Words of letters with a tail of plain punctuation are looked up in two parts, as the
    tokenizer itself splits there. Of words, the last ``CACHE_WORDS`` to twice as many are held: a full
    table becomes the older one, and words that are met again move on.
    """

    PLAIN_TAIL = b".,!?*&$%#|;:()"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}

    @staticmethod
    def _ends_apart(head: bytes) -> bool:
        """Whether punctuation behind it is a piece of its own: it ends in a letter, or an ASCII digit.

        Some letters end in a mark once they are composed and lower-cased, as the tokenizer does.
        """
        if head[-1] < 128:
            return head[-1:].isalnum()
        return unicodedata.normalize("NFC", head.decode()[-1]).lower().isalpha()

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            head = word.rstrip(self.PLAIN_TAIL)
            if head and head != word and self._ends_apart(head):
                found = self[head] + self[word[len(head) :]]
            else:
                encoded = self.tokenizer.encode(word.decode(), add_special_tokens=False)
                found = array("I", encoded.ids).tobytes()
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


_word_ids: dict[str, WordIds] = {}


def _vocabulary(path: str) -> WordIds:
    if path not in _word_ids:
        import public_tokenizers

        found = path if path.startswith("/") else public_tokenizers.path(path)
        _word_ids[path] = WordIds(found)
    return _word_ids[path]


def token_bytes(text: bytes, words: WordIds) -> bytes:
    """All ids of a document, the end id included, as little-endian 32-bit bytes."""
    if b"<|" not in text:  # the tokenizer lower-cases all but its own marks
        text = text.lower()
    parts = text.replace(b"\n", b" ").split(b" ")
    return b"".join(map(words.__getitem__, parts)) + END_OF_TEXT.to_bytes(4, "little")


def tokenised_pieces(
    docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; only longer documents are cut. NULL text: one id."""

    def pieces(batch) -> Iterator[dict]:
        words = _vocabulary(vocabulary)
        owner, rows = [], []
        for i, text in enumerate(texts(batch)):
            data = token_bytes(text, words)
            step = 4 * capacity
            for k, at in enumerate(range(0, len(data), step)):
                part = data[at : at + step]
                owner.append(i)
                rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield {
            "doc_id": ids(batch).take(np.array(owner, np.int64)),
            **dict(zip(("piece", "start", "length", "ids_crc32"), columns, strict=True)),
        }

    def forget() -> None:  # Python workers serve later stages, too
        _vocabulary(vocabulary).older = {}

    return map_texts(id_and_text(docs), PIECES, pieces, at_end=forget)


def best_configuration(
    lengths: np.ndarray, prices: np.ndarray, capacity: int
) -> tuple[dict[int, int], float]:
    """Unbounded knapsack: the multiset of lengths within ``capacity`` of the greatest price, and that."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(int(lengths[0]), capacity + 1):
        n = fits[c]
        values = best[c - lengths[:n]] + prices[:n]
        k = int(values.argmax())
        best[c], choice[c] = values[k], k
        if best[c - 1] >= best[c]:
            best[c], choice[c] = best[c - 1], -1
    chosen: dict[int, int] = {}
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
            continue
        chosen[int(choice[c])] = chosen.get(int(choice[c]), 0) + 1
        c -= int(lengths[choice[c]])
    return chosen, float(best[capacity])


def priced_round(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, enough: float
) -> tuple[list[tuple[dict, int]], float]:
    """One fractional solution by multiplicative weights, rounded down so that nothing is overused.

    Prices divided by the greatest price of a configuration are a dual solution: what all pieces cost is
    a bound below which no packing goes. It is returned; once it reaches ``enough`` pricing stops.
    """
    bound = 0.0
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = {}
    base = lengths / capacity
    for _ in range(PRICINGS):
        prices = base * np.exp(-covered / counts)
        config, dearest = best_configuration(lengths, prices, capacity)
        bound = max(bound, float((counts * prices).sum()) / dearest)
        if bound > enough:
            break
        at = np.fromiter(config, np.int64)
        times = np.fromiter(config.values(), np.float64)
        step = SHARE * float((counts[at] / times).min())
        covered[at] += times * step
        key = tuple(sorted(config.items()))
        used[key] = used.get(key, 0.0) + step
    scale = min(1.0, float((counts / np.maximum(covered, 1e-9)).min()))
    left = counts.copy()
    rounded = []
    for key, amount in sorted(used.items(), key=lambda kv: -kv[1]):
        n = min([math.floor(amount * max(scale, SHARE) + 1e-9)] + [left[i] // m for i, m in key])
        if n > 0:
            for i, m in key:
                left[i] -= n * m
            rounded.append((dict(key), int(n)))
    counts[:] = left
    return rounded, bound


def best_fit_groups(lengths, counts, capacity: int, started) -> list[tuple[dict, int]]:
    """Best fit, longest pieces first, over groups of equally filled sequences.

    ``started`` are sequences that are partly filled already; all sequences are returned.
    """
    open_groups: dict[int, list] = {}  # room left -> list of [content, how many sequences]
    for content, many in started:
        room = capacity - sum(int(lengths[i]) * m for i, m in content.items())
        open_groups.setdefault(room, []).append([content, many])
    for k in np.argsort(-lengths):
        length, n = int(lengths[k]), int(counts[k])
        while n > 0:
            rooms = [r for r in open_groups if r >= length]
            if not rooms:
                per = capacity // length
                full, rest = divmod(n, per)
                for times, many in ((per, full), (rest, 1)):
                    if times and many:
                        group = [{int(k): times}, many]
                        open_groups.setdefault(capacity - times * length, []).append(group)
                break
            room = min(rooms)
            content, many = open_groups[room].pop()
            if not open_groups[room]:
                del open_groups[room]
            times = min(room // length, max(1, n // many))
            take = min(many, n // times)
            if many > take:
                open_groups.setdefault(room, []).append([content, many - take])
            more = {**content, int(k): content.get(int(k), 0) + times}
            open_groups.setdefault(room - times * length, []).append([more, take])
            n -= times * take
    return [(content, many) for groups in open_groups.values() for content, many in groups]


@dataclass(frozen=True)
class Placement:
    """Ranges of ranks per length and where their pieces go; sorted by length, then rank."""

    key: np.ndarray  # length and first rank in one number
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    sequences: int
    bound: int  # no packing has fewer sequences

    SHIFT = 45

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << self.SHIFT) + rank, side="right") - 1
        inside = rank - self.first[at]
        sequence = self.sequence[at] + inside // self.times[at]
        return sequence, self.offset[at] + (inside % self.times[at]) * length


def fewest(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[dict, int]], int]:
    """Configurations (index of length -> times, how many) for all pieces, and a bound from below.

    Rounding leaves pieces over, and a configuration that wastes room is best opened again. So the
    rounded program is completed by best fit from several points, from all of its configurations to none
    of them, and the least number of sequences counts: never more than best fit alone needs.
    """
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    best = best_fit_groups(lengths, counts, capacity, [])
    fewest_yet = sum(n for _, n in best)
    bound = math.ceil(int((lengths * counts).sum()) / capacity)
    left, program = counts.copy(), []
    for number in range(ROUNDS):
        live = left > 0
        if not live.any() or bound >= fewest_yet:
            break
        index, part = np.flatnonzero(live), left[live].copy()
        rounded, below = priced_round(lengths[live], part, capacity, fewest_yet - 1 if number == 0 else math.inf)
        if number == 0:
            bound = max(bound, math.ceil(below - 1e-6))
        program += [({int(index[i]): m for i, m in config.items()}, n) for config, n in rounded]
        left[live] = part
    for least_full in FILLS:
        kept, rest = [], counts.copy()
        for config, n in program:
            if sum(int(lengths[i]) * m for i, m in config.items()) >= least_full * capacity:
                kept.append((config, n))
                for i, m in config.items():
                    rest[i] -= m * n
        completed = best_fit_groups(lengths, rest, capacity, kept)
        if sum(n for _, n in completed) < fewest_yet:
            best, fewest_yet = completed, sum(n for _, n in completed)
    return best, bound


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Placement:
    """Configurations for a length histogram, as ranges of ranks."""
    lengths = np.array(sorted(histogram), np.int64)
    chosen, bound = fewest(histogram, capacity)
    next_rank = np.zeros(len(lengths), np.int64)
    rows, sequence = [], 0
    for config, n in chosen:
        offset = 0
        for i, m in sorted(config.items()):
            rows.append((lengths[i], next_rank[i], m, sequence, offset))
            next_rank[i] += m * n
            offset += m * int(lengths[i])
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    length, first, times, seq, offset = table.T
    return Placement(
        (length << Placement.SHIFT) + first, first, times, seq, offset, length, sequence, bound
    )


def with_ranks(pieces: DataFrame, total: int) -> DataFrame:
    """Each piece's rank among the pieces of its length.

    A length may hold any share of the rows, so it is dealt over buckets: ranks are numbered inside
    a bucket and start where the buckets before it end. The number of buckets follows the number of
    pieces.
    """
    buckets = max(1, math.ceil(total / ROWS_PER_BUCKET))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("number", F.row_number().over(inside))
    return numbered.join(starts, ["length", "bucket"]).select(
        *pieces.columns, (F.col("first_rank") + F.col("number") - 1).alias("rank")
    )


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A NULL or empty
    text is one end id. Repeated rows are packed as often as they occur. A NULL doc_id stays NULL.
    """
    pieces = stored(tokenised_pieces(docs, vocabulary, capacity), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placement = plan(histogram, capacity)

    def placed(batch) -> Iterator[dict]:
        length = batch.column("length").to_numpy()
        sequence, offset = placement.place(length, batch.column("rank").to_numpy())
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        yield {**{n: batch.column(n) for n in names}, "sequence_id": sequence, "offset": offset}

    ranked = with_ranks(pieces, sum(histogram.values()))
    return map_texts(ranked, f"{PIECES}, sequence_id bigint, offset bigint", placed)
