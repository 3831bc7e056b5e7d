"""Personal data by bootstrapped contextual extraction. Built-in functions only.

**Seeds.** Four kinds of identifiers have patterns of their own (`KINDS`); their matches are the seeds.

**Candidates.** Every other word with a digit or an at sign may be an identifier in a form no pattern
knows; so may two to ``GROUPS`` neighbouring groups of digits, and an address written out with "at" and "dot".

**Graph.** The words around an identifier are its lexical patterns: the two words before, and the word
before with the word after. Patterns and values form a graph, one edge however often a value stands in
a pattern. A pattern's confidence for a kind is the weight of its values of that kind against all its
values; a value weighs as much as its best pattern, if it looks like the kind at all; seeds always weigh
one. A pattern counts with ``SUPPORT`` different values that are seeds or sure by now: values that
patterns discovered support and induce patterns of their own. Weights only grow, and rounds go on until
one brings no new sure value and raises all weights together by a share of ``STILL`` at most.

**Discovery.** Candidates in a pattern of confidence ``SURE`` and more with that support are spans of
that kind if they look like it. Base spans stay as they are.

The text is read once. Positions come from splitting a text at the matches: a match starts where the
pieces and matches before it end. Patterns are written so that matching takes linear time and no
deep recursion on long texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, stored

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, possessive, starting only where a match can start.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
_SPACE = r"\x20\x09-\x0D"
GROUPS = 8
_DIGITS = r"[(]?[0-9][0-9()./-]*+"
RUN = rf"{_DIGITS}(?:\x20{_DIGITS}){{1,{GROUPS - 1}}}+(?![^{_SPACE},;:!?\"'])"
CANDIDATE = rf"(?<![^{_SPACE}])(?:{RUN}|[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+)"
_AT, _DOT = r"\x20[(\[]?at[)\]]?\x20", r"\x20[(\[]?dot[)\]]?\x20"
WRITTEN = rf"(?i)(?<![^{_SPACE}])[A-Z0-9._%+-]++{_AT}[A-Z0-9-]++(?:{_DOT}[A-Z0-9-]++)++"
CONTEXT = 64
STILL = 0.001
SUPPORT, SURE, PROPAGATED, DOUBT = 5, 0.8, 0.5, 1.0
DIGITS = {"ip": (7, 12), "card": (12, 19), "phone": (7, 15)}

SPAN = "struct<kind: string, start: int, end: int, match: string, left: string, right: string>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern with start, end and match, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.slice(F.arrays_zip(between.alias("b"), found.alias("m")), F.lit(1), F.size(found))
    nothing = F.array().cast("array<struct<start: int, end: int, match: string>>")

    def step(done: Column, here: Column) -> Column:
        start = done["at"] + F.char_length(here["b"])
        end = start + F.char_length(here["m"])
        span = F.struct(start.alias("start"), end.alias("end"), here["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(both, first, step, lambda done: done["out"])).otherwise(
        nothing
    )


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a right check digit."""
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        doubled = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def is_valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        digits = digits_of(match)
        return F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits_of(match)).between(9, 15)
    return F.lit(True)


def _check_of(kind: str):
    return lambda m: is_valid(kind, m["match"])


def with_context(text: Column, kind: str | None, found: Column) -> Column:
    """Matches as `SPAN` with what stands within ``CONTEXT`` characters before and after."""

    def span(m: Column) -> Column:
        back = F.least(m["start"], F.lit(CONTEXT))
        return F.struct(
            F.lit(kind).cast("string").alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            m["match"].alias("match"),
            F.substring(text, m["start"] - back + 1, back).alias("left"),
            F.substring(text, m["end"] + 1, F.lit(CONTEXT)).alias("right"),
        )

    return F.transform(found, span)


def found_spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``mark`` of the text, base spans per kind, words and written addresses beside them."""
    text = F.col("text")
    none = F.array().cast(f"array<{SPAN}>")
    columns = {}
    for kind, pattern in PATTERNS.items():
        found = F.filter(matches(text, pattern), _check_of(kind))
        spans = with_context(text, kind, found)
        needed = text.contains(NEEDED[kind]) if kind in NEEDED else text.rlike("[0-9]")
        columns[kind] = F.when(needed, spans).otherwise(none)
    words = with_context(text, None, matches(text, CANDIDATE))
    columns["words"] = F.when(text.rlike("[0-9@]"), words).otherwise(none)
    written = with_context(text, None, matches(text, WRITTEN))
    columns["written"] = F.when(text.rlike(rf"(?i){_DOT}"), written).otherwise(none)
    rows = stored(
        id_and_text(docs).select(
            "doc_id",
            F.xxhash64("text").alias("mark"),
            *[c.cast(f"array<{SPAN}>").alias(name) for name, c in columns.items()],
        ),
        "personal-spans",
    )
    return rows


def _words(text: Column, pattern: str, group: int) -> Column:
    """A context word in lower case, all digits alike."""
    return F.lower(F.regexp_replace(F.regexp_extract(text, pattern, group), "[0-9]", "9"))


def occurrences(found: DataFrame) -> DataFrame:
    """Seeds and candidates with their value and lexical patterns; candidates touch no seed and no other."""
    seeds = found.select("doc_id", "mark", F.inline(F.concat(*KINDS)))
    base = F.concat(*KINDS)

    def apart(of: str, others: Column) -> Column:
        touches = lambda w: F.exists(others, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))
        return F.filter(of, lambda w: ~touches(w))

    free = found.select("doc_id", "mark", "words", *KINDS, apart("written", base).alias("written"))
    candidates = F.concat("written", apart("words", F.concat(base, F.col("written"))))
    words = free.select("doc_id", "mark", F.inline(candidates))
    both = seeds.union(words)
    last = rf"([^{_SPACE}]+)[{_SPACE}]+([^{_SPACE}]+)[{_SPACE}]*$"
    before, nearest = _words(F.col("left"), last, 1), _words(F.col("left"), last, 2)
    after = _words(F.col("right"), rf"^[{_SPACE}]*([^{_SPACE}]+)", 1)
    return both.select(
        "doc_id",
        "mark",
        "kind",
        "start",
        "end",
        "match",
        F.lower(F.regexp_replace("match", r"[.,;:!?)\"']+$", "")).alias("value"),
        F.array_distinct(
            F.filter(
                F.array(
                    F.when((before != "") & (nearest != ""), F.concat_ws(" ", before, nearest, F.lit("_"))),
                    F.when((nearest != "") & (after != ""), F.concat_ws(" ", nearest, F.lit("_"), after)),
                ),
                lambda p: p.isNotNull(),
            )
        ).alias("patterns"),
    )


def looks_like(kind: Column, value: Column) -> Column:
    """Whether a candidate's value may be of a kind: number of digits, or an address."""
    digits = F.char_length(digits_of(value))
    fits = F.when(kind == "email", value.contains("@") | value.rlike(_DOT))
    for name, (least, most) in DIGITS.items():
        fits = fits.when(kind == name, digits.between(least, most))
    return fits


def pattern_confidence(seen: DataFrame) -> DataFrame:
    """pattern, kind, confidence, support (seeds and sure values) from the graph of patterns and values.

    Edges are distinct before anything is joined, and all sums combine before their exchange, so a
    pattern or value that holds a third of all occurrences costs one row per task.
    """
    edges = stored(
        seen.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct(), "pattern-edges"
    )
    plain = edges.select("pattern", "value").distinct()
    sizes = plain.groupBy("pattern").agg(F.count("*").alias("values"))
    seeds = edges.filter("kind is not null").select("value", "kind").distinct()
    fixed = seeds.select("value", "kind", F.lit(1.0).alias("weight"))
    weights, sure, total = fixed, 0, 0.0
    while True:
        confidence = stored(
            plain.join(weights, "value")
            .groupBy("pattern", "kind")
            .agg(F.sum("weight").alias("mass"), F.count_if(F.col("weight") >= SURE).alias("support"))
            .join(sizes, "pattern")
            .select(
                "pattern",
                "kind",
                (F.col("mass") / (F.col("values") + DOUBT)).alias("confidence"),
                "support",
            ),
            "pattern-confidence",
        )
        passed = confidence.filter((F.col("confidence") >= PROPAGATED) & (F.col("support") >= SUPPORT))
        learned = stored(
            plain.join(passed, "pattern")
            .filter(looks_like(F.col("kind"), F.col("value")))
            .groupBy("value", "kind")
            .agg(F.max("confidence").alias("weight"))
            .join(seeds, ["value", "kind"], "left_anti"),
            "values-learned",
        )
        now = learned.agg(
            F.count_if(F.col("weight") >= SURE).alias("sure"),
            F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total"),
        ).first()
        if now.sure == sure and now.total <= total * (1 + STILL):
            return confidence
        weights, sure, total = fixed.union(learned.select("value", "kind", "weight")), now.sure, now.total


def discovered(seen: DataFrame, confidence: DataFrame) -> DataFrame:
    """Candidates in patterns that are sure: doc_id, mark, kind, start, end. One kind per candidate."""
    sure = confidence.filter((F.col("confidence") >= SURE) & (F.col("support") >= SUPPORT)).select(
        "pattern", F.col("kind").alias("kind_found"), "confidence"
    )
    words = seen.filter("kind is null").select(
        "doc_id", "mark", "start", "match", "value", F.explode("patterns").alias("pattern")
    )
    best = (
        words.join(sure, "pattern")
        .filter(looks_like(F.col("kind_found"), F.col("value")))
        .groupBy("doc_id", "mark", "start", "value")
        .agg(F.max(F.struct("confidence", "kind_found")).alias("best"))
    )
    return best.select(
        "doc_id",
        "mark",
        F.col("best.kind_found").alias("kind"),
        "start",
        (F.col("start") + F.char_length("value")).alias("end"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _ordered(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(kinds, s["kind"]).alias("at"), s["start"].alias("start"),
            s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.array_sort(F.array_distinct(keyed))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_found.

    ``spans`` holds base spans and those of sure patterns as kind:start:end, in code points, ends
    exclusive; ``n_found`` counts the latter. One row per input row. NULL and empty texts have none.
    Repeated rows get the same spans. Rows without a doc_id get base spans only.
    """
    found = found_spans(docs)
    seen = stored(occurrences(found), "identifier-occurrences")
    more = (
        discovered(seen, pattern_confidence(seen))
        .groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"))
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))
    )
    more = stored(more, "identifiers-found")
    rows = found.join(
        more, (found["doc_id"] == more["_doc"]) & (found["mark"] == more["_mark"]), "left"
    )
    base = F.transform(
        F.concat(*KINDS), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    extra = F.coalesce("more", F.array().cast("array<struct<kind: string, start: int, end: int>>"))
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(_ordered(F.concat(base, extra))).alias("spans"),
        F.size(extra).cast("bigint").alias("n_found"),
    )
