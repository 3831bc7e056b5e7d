"""Repeated passages by relative Lempel-Ziv parsing of documents against the whole corpus.

A document is parsed into factors, runs of words that stand earlier in the corpus. A factor of at
least ``WINDOW`` words is a duplicate span.

**Reference blocks.** Every window of ``WINDOW`` words has an anchor: the least of the hashes of its
``ANCHOR``-word runs, frequent ones last. Neighbouring windows with the same anchor form a block. The
same passage is cut into the same blocks wherever it stands, so all occurrences of a block meet on
its anchor, and all blocks of all documents are the index. A block is greedily taken as a factor whole
if the same block stands earlier.

**Boundaries.** Where a passage begins or ends, its blocks have the anchor of the reference's but not
its words. Only those, once per distinct block, are compared window by window; windows that stand
earlier are factors of their own. Blocks alone on their anchor are new text.

Each step is one exchange by hash; rows come sorted and are read as a stream, so no group is held.
Equal blocks of one batch are one before the exchange. Overlapping factors are joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    RunHashes,
    common_hashes,
    id_and_text,
    ids,
    is_in,
    map_texts,
    signed,
    stored,
    texts,
    window_hashes,
    word_hashes,
    words_of,
)

WINDOW = 20
ANCHOR = 8
WORDS_AT_ONCE = 400_000
TEXTS_AT_ONCE = 10_000  # equal blocks of so many texts are one before the exchange
SPANS_BROADCAST = 4_000_000

FACTOR, BOUNDARY = 1, 2


def anchored_blocks(
    h: np.ndarray, ends: np.ndarray, common: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of texts written one after the other: first window, windows, anchor, hash of the words.

    ``h`` are the word hashes of all texts, ``ends`` where each text ends.
    """
    count = len(h) - window + 1
    nothing = np.empty(0, np.int64)
    if count <= 0:
        return nothing, nothing, nothing.view(np.uint64), nothing.view(np.uint64)
    grams = window_hashes(h, anchor)
    rank = (grams >> np.uint64(1)) | (is_in(grams, common).astype(np.uint64) << np.uint64(63))
    reach = window - anchor + 1
    least = rank[:count].copy()
    for j in range(1, reach):
        np.minimum(least, rank[j : count + j], out=least)
    place = np.zeros(count, np.int64)
    for j in range(reach - 1, -1, -1):
        same = rank[j : count + j] == least
        place[same] = np.flatnonzero(same) + j
    starts = np.arange(count)
    text = np.searchsorted(ends, starts, side="right")
    whole = starts + window <= ends[np.minimum(text, len(ends) - 1)]
    starts, place, text = starts[whole], place[whole], text[whole]
    if not len(starts):
        return nothing, nothing, nothing.view(np.uint64), nothing.view(np.uint64)
    new = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(new)
    windows = np.diff(np.r_[first, len(starts)])
    begin = starts[first]
    words = RunHashes(h).hash_of(begin, begin + windows + window - 1)
    return begin, windows, grams[place[first]], words


BLOCKS = "key bigint, words bigint, doc_id bigint, start int, windows int, known boolean"


def document_blocks(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Blocks of all documents. ``known``: the same block stands earlier in the same batch."""

    def rows(batch) -> Iterator[dict]:
        owners = batch.column("doc_id").to_numpy()
        held: list[np.ndarray] = []
        first = 0
        parts: list[tuple] = []
        for i, text in enumerate(texts(batch)):
            held.append(word_hashes(words_of(text)))
            if sum(map(len, held)) >= WORDS_AT_ONCE:
                parts.append(blocks(held, owners[first : i + 1]))
                held, first = [], i + 1
        parts.append(blocks(held, owners[first:]))
        key, words, doc, start, windows = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((start, doc, words, key))
        key, words, doc, start, windows = (c[order] for c in (key, words, doc, start, windows))
        known = stands_earlier(words, doc, start)
        # known blocks only pass through the exchange, so they are spread over it
        spread = signed(word_hash(doc, start))
        yield {
            "key": np.where(known, spread, signed(key)),
            "words": signed(words),
            "doc_id": doc,
            "start": start,
            "windows": windows,
            "known": known,
        }

    def blocks(held: list[np.ndarray], owners: np.ndarray) -> tuple:
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        ends = np.cumsum(sizes)
        h = np.concatenate([np.empty(0, np.uint64), *held])
        begin, windows, key, words = anchored_blocks(h, ends, common)
        text = np.searchsorted(ends, begin, side="right")
        doc = owners[text] if len(begin) else np.empty(0, np.int64)
        start = begin - (ends - sizes)[text] if len(begin) else begin
        return key, words, doc, start, windows

    return map_texts(docs, BLOCKS, rows, rows_at_once=TEXTS_AT_ONCE)


def word_hash(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    return RunHashes._finished(doc.astype(np.uint64) << np.uint64(20), start, 7)


def stands_earlier(h: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For rows sorted by hash, document, start: which come after the first place of their hash."""
    if not len(h):
        return np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(np.r_[True, h[1:] != h[:-1]], np.arange(len(h)), 0))
    return (doc != doc[first]) | (start != start[first])


class _Stream:
    """Sorted rows in batches; remembers the first place of the hash and of the key it is in."""

    def __init__(self):
        self.hash = self.place = self.key = self.pending = None
        self.several = False


def parsed_blocks(blocks: DataFrame) -> DataFrame:
    """``FACTOR``: blocks that stand earlier. ``BOUNDARY``: first places of the blocks of an anchor
    that has several different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Stream()
        names = ("key", "words", "doc_id", "start", "windows")
        for batch in batches:
            key, words, doc, start, windows = (batch.column(c).to_numpy() for c in names)
            known = batch.column("known").to_numpy(zero_copy_only=False)
            n = len(key)
            if not n:
                continue
            new_key = np.r_[state.key is None or key[0] != state.key, key[1:] != key[:-1]]
            new_hash = new_key | np.r_[state.hash is None or words[0] != state.hash, words[1:] != words[:-1]]
            first = np.maximum.accumulate(np.where(new_hash, np.arange(n), -1))
            first_doc = np.where(first >= 0, doc[first], state.place[0] if state.place else 0)
            first_start = np.where(first >= 0, start[first], state.place[1] if state.place else 0)
            factor = known | (doc != first_doc) | (start != first_start)
            # an anchor has several blocks from its second new hash on
            group = np.cumsum(new_key)
            hashes = np.cumsum(new_hash)
            before = np.maximum.accumulate(np.where(new_key, hashes - 1, 0))
            nth = hashes - before
            carried = group == 0
            if state.key is not None:
                nth = np.where(carried, hashes + 1 + state.several, nth)
            opens = new_hash & ~known
            many = np.zeros(n, bool)
            later = opens & (nth > 1)
            has_later = np.unique(group[later])
            many[opens] = np.isin(group[opens], has_later)
            extra = []
            if 0 in has_later and state.pending is not None:
                extra = [state.pending]
            boundary = many | later
            at = np.flatnonzero(factor | boundary)
            last_group = group == group[-1]
            opened = np.flatnonzero(opens & last_group)
            several = bool((later & last_group).any()) or (group[-1] == 0 and state.several)
            if group[-1] != 0:
                state.pending = None
            if several:
                state.pending = None
            elif len(opened):
                k = opened[0]
                state.pending = (doc[k], start[k], windows[k])
            state.several, state.key, state.hash = several, key[-1], words[-1]
            state.place = (first_doc[-1], first_start[-1])
            extra_columns = np.array(extra, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(extra), BOUNDARY), np.where(factor[at], FACTOR, BOUNDARY)]), pa.int32()),
                    pa.array(np.concatenate([extra_columns[:, 0], doc[at]]), pa.int64()),
                    pa.array(np.concatenate([extra_columns[:, 1], start[at]]), pa.int32()),
                    pa.array(np.concatenate([extra_columns[:, 2], windows[at]]), pa.int32()),
                ],
                names=["kind", "doc_id", "start", "windows"],
            )

    dealt = blocks.repartition("key").sortWithinPartitions("key", "words", "doc_id", "start")
    return dealt.mapInArrow(run, "kind int, doc_id bigint, start int, windows int")


def boundary_windows(docs: DataFrame, boundary: DataFrame) -> DataFrame:
    """Windows of boundary blocks that stand earlier, as factors of one window."""
    per_doc = stored(
        boundary.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("blocks")),
        "boundary-blocks",
    )
    total = per_doc.agg(F.sum(F.size("blocks"))).first()[0] or 0
    read = docs.join(F.broadcast(per_doc) if total <= SPANS_BROADCAST else per_doc, "doc_id")

    def rows(batch) -> Iterator[dict]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owners = batch.column("doc_id").to_numpy()
        for owner, text, blocks in zip(
            owners, texts(batch), batch.column("blocks").to_pylist(), strict=True
        ):
            h = window_hashes(word_hashes(words_of(text)), WINDOW)
            starts = np.concatenate(
                [np.arange(b["start"], b["start"] + b["windows"]) for b in blocks]
            )
            starts = np.unique(starts[starts < len(h)])  # rows of one doc_id may differ in text
            found.append((h[starts], np.full(len(starts), owner), starts))
        h, doc, start = (
            (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.uint64),) * 3
        )
        order = np.lexsort((start, doc, h))
        h, doc, start = h[order], doc[order], start[order]
        known = stands_earlier(h, doc, start)
        yield {
            "h": np.where(known, signed(word_hash(doc, start)), signed(h)),
            "doc_id": doc.astype(np.int64),
            "start": start.astype(np.int64),
            "known": known,
        }

    windows = map_texts(read, "h bigint, doc_id bigint, start int, known boolean", rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            h, doc, start = (batch.column(c).to_numpy() for c in ("h", "doc_id", "start"))
            known = batch.column("known").to_numpy(zero_copy_only=False)
            if not len(h):
                continue
            new = np.r_[last is None or h[0] != last[0], h[1:] != h[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            first_doc = np.where(first >= 0, doc[first], last[1] if last else 0)
            first_start = np.where(first >= 0, start[first], last[2] if last else 0)
            at = np.flatnonzero(known | (doc != first_doc) | (start != first_start))
            last = (h[-1], first_doc[-1], first_start[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[at], pa.int64()),
                    pa.array(start[at], pa.int32()),
                    pa.array(np.ones(len(at)), pa.int32()),
                ],
                names=["doc_id", "start", "windows"],
            )

    dealt = windows.repartition("h").sortWithinPartitions("h", "doc_id", "start")
    return dealt.mapInArrow(run, "doc_id bigint, start int, windows int")


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap as one; sorted."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """doc_id and its duplicate ``spans`` (first word, end exclusive), for documents that have some."""
    read = id_and_text(docs).filter("doc_id is not null")
    common = common_hashes(read, lambda text: window_hashes(word_hashes(words_of(text)), ANCHOR))
    parsed = stored(parsed_blocks(document_blocks(read, common)), "parsed-blocks")
    boundary = parsed.filter(F.col("kind") == BOUNDARY).select("doc_id", "start", "windows")
    single = stored(boundary_windows(read, boundary), "boundary-windows")
    factors = parsed.filter(F.col("kind") == FACTOR).select("doc_id", "start", "windows").union(single)
    per_doc = factors.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("factors"))

    def rows(batch) -> Iterator[dict]:
        spans = []
        for factors in batch.column("factors"):
            both = factors.values.flatten()
            starts = both[0].to_numpy().astype(np.int64)
            begin, end = joined_spans(starts, starts + both[1].to_numpy() + WINDOW - 1)
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)])
        yield {"doc_id": ids(batch), "spans": spans}

    return map_texts(per_doc, "doc_id bigint, spans array<struct<start: int, end: int>>", rows)


def remove_repeated_passages(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each row's words without its duplicate spans.

    ``kept`` joins the remaining words by one space; ``with_text=False`` leaves that column out. NULL and empty texts have no words. Rows of one
    doc_id stand at the same place, so none is a copy of the other. Rows without a doc_id have no place:
    they are neither parsed nor referred to.
    """
    read = id_and_text(docs)
    spans = stored(duplicate_spans(docs), "spans")
    total = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    both = read.join(F.broadcast(spans) if total <= SPANS_BROADCAST else spans, "doc_id", "left")

    def rows(batch) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "kept")}
        for text, found in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            words = words_of(text)
            left: list[bytes] = []
            at = 0
            for span in found or ():
                left += words[at : span["start"]]
                at = span["end"]
            left += words[at:]
            kept = b" ".join(left)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(left))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept.decode())
        yield {"doc_id": ids(batch), **out}

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_texts(both, f"{schema}, kept string" if with_text else schema, rows)
