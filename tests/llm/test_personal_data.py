"""Base spans against the contract's patterns in another regex engine; discovery; odd rows."""

import hashlib
import random
import re

import pytest
from conftest import SF_DIR

from tidemark.llm.common import documents
from tidemark.llm.personal_data import (
    discovered,
    found_spans,
    occurrences,
    pattern_confidence,
    personal_data,
)

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    found = personal_data(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for k, _, _ in want) for kind in PLAIN
        ]
        assert set(filter(None, joined(want).split(","))) <= set(r.spans.split(","))
        if not r.n_found:
            assert r.spans == joined(want)
    return {r.doc_id: r for r in found}


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    found = check(spark, rows)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in found.values()) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_of_identifiers(spark, seed):
    rng = random.Random(seed)
    pieces = ["a", "b.c", "@", "@x.y", ".", "..", "-", "_", "+", "+1", " ", "(", ")", "1", "22", "255", "256",
              "4111 1111 1111 1111", "4111-1111-1111-1111", "0", "1.2.3.4", "é", "😀", "\n", "%", "007", "1.1"]
    rows = [(i, "".join(rng.choices(pieces, k=rng.choice([3, 8, 20])))) for i in range(400)]
    check(spark, rows)


def test_long_runs_take_linear_time(spark):
    check(spark, [
        (1, "a" * 60_000), (2, "a." * 30_000), (3, "x@" + "a." * 30_000), (4, "1." * 30_000),
        (5, "1 " * 30_000), (6, "+1" + " (" * 30_000), (7, "a@b.c " * 2_000), (8, "é" * 50_000 + "1.2.3.4"),
    ])


def test_patterns_discover_what_no_pattern_knows(spark):
    rows = [(i, f"well then reach me on +1 (555) 100-{2000 + i} any day {i}") for i in range(20)]
    rows += [(100 + i, f"the order number was {10_000_000 + i} I think") for i in range(20)]
    rows += [(200, "please reach me on 0171-555-0199, thanks"), (201, "reach me on monday")]
    rows += [(202, "the order number was +1 (555) 100-2999 once")]
    found = check(spark, rows)
    start = rows[40][1].index("0171")
    assert found[200].spans == f"phone:{start}:{start + 13}"
    assert all(found[100 + i].spans == "" for i in range(20)) and found[201].spans == ""
    assert found[202].n_phone == 1


def first_generation():
    return [(i, f"well then reach me on +1 (555) 100-{2000 + i} any day {i}") for i in range(20)]


@pytest.mark.parametrize("form", ["0171 555 0199", "(0171) 555 0199", "0171.555.0199", "0171-555 01 99"])
def test_identifiers_of_several_groups(spark, form):
    rows = [*first_generation(), (200, f"please reach me on {form}, thanks"), (201, "reach me on 12 13 today"),
            (202, "reach me on " + "1234567 " * 9 + "x"), (203, f"please reach on my {form} mind")]
    found = check(spark, rows)
    start = rows[20][1].index(form)
    assert found[200].spans == f"phone:{start}:{start + len(form)}"
    assert found[201].spans == found[202].spans == found[203].spans == ""


def test_addresses_written_out(spark):
    rows = [(i, f"please send it to box{i}@mail{i}.example.com before noon {i}") for i in range(20)]
    jane, joe = "jane at example dot com", "Joe99 [at] a-b (dot) co dot uk"
    rows += [(100, f"we send it to {jane}, or so"), (101, f"we send it to {joe}"), (102, "they stood at the dot com line"), (103, "send it to jane at home")]
    found = check(spark, rows)
    assert found[100].spans == f"email:14:{14 + len(jane)}" and found[101].spans == f"email:14:{14 + len(joe)}"
    assert found[102].spans == found[103].spans == ""


def test_discovered_values_induce_patterns(spark):
    rows = first_generation()
    unknown = [f"0171 555 01{i}" for i in range(20, 28)]
    rows += [(100 + i, f"do reach me on {v} tonight") for i, v in enumerate(unknown)]
    rows += [(200 + i, f"fax goes via {v} these weeks") for i, v in enumerate(unknown)]
    rows += [(300, "fax goes via 0171 555 0999 these days"), (301, "mail runs over 0171 555 0998 these days")]
    found = check(spark, rows)
    assert all(found[100 + i].n_found == found[200 + i].n_found == 1 for i in range(8))
    assert found[300].spans == "phone:13:26" and found[301].spans == ""


def graph_by_brute_force(seen):
    """The fixed point on lists: confidence and support per pattern and kind."""
    kinds = {(r.value, r.kind) for r in seen if r.kind}
    values = {}
    for r in seen:
        for p in r.patterns:
            values.setdefault(p, set()).add(r.value)

    def fits(kind, value):
        n = len(re.sub("[^0-9]", "", value))
        least, most = {"ip": (7, 12), "card": (12, 19), "phone": (7, 15), "email": (0, -1)}[kind]
        return least <= n <= most or kind == "email" and ("@" in value or " dot " in value)

    weights = dict.fromkeys(kinds, 1.0)
    for _ in range(100):
        about = {}
        for p, here in values.items():
            for kind in {"email", "ip", "card", "phone"}:
                w = [weights[v, kind] for v in here if (v, kind) in weights]
                if w:
                    about[p, kind] = (sum(w) / (len(here) + 1), sum(x >= 0.8 for x in w))
        after = dict.fromkeys(kinds, 1.0)
        for (p, kind), (confidence, support) in about.items():
            if confidence >= 0.5 and support >= 5:
                for v in values[p]:
                    if (v, kind) not in kinds and fits(kind, v):
                        after[v, kind] = max(after.get((v, kind), 0), confidence)
        if after == weights:
            break
        weights = after
    sure = {(p, k) for (p, k), (c, n) in about.items() if c >= 0.8 and n >= 5}
    return {
        (r.doc_id, r.start)
        for r in seen
        if not r.kind and any((p, k) in sure and fits(k, r.value) for p in r.patterns for _, k in sure)
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_graph_by_brute_force(spark, seed):
    rng = random.Random(seed)
    frames = ["call me on {} now", "ring us at {} soon", "fax goes via {} here", "the host is {} up", "order no {} came"]
    forms = [lambda: f"+44 20 {rng.randint(1000000, 1000030)}", lambda: f"0171 555 {rng.randint(1000, 1020)}",
             lambda: f"10.0.0.{rng.randint(1, 30)}", lambda: f"10-0-0-100{rng.randint(1, 9)}", lambda: f"{rng.randint(1, 30)}"]
    odds = [[rng.choice([0, 0, 1, 9]) for _ in forms] for _ in frames]
    rows = []
    for i in range(400):
        at = rng.randrange(len(frames))
        if any(odds[at]):
            rows.append((i, frames[at].format(rng.choices(forms, odds[at])[0]())))
    seen = occurrences(found_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))).cache()
    found = {(r.doc_id, r.start) for r in discovered(seen, pattern_confidence(seen)).collect()}
    assert found == graph_by_brute_force(seen.collect())


def test_no_python_in_the_plan(spark, capsys):
    personal_data(documents(spark, SF_DIR)).explain()
    plan = capsys.readouterr().out
    for bad in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def test_odd_rows(spark):
    odd = [(None, "a@b.cd", 1), (1, None, 2), (2, "", 3), (3, "x 1.2.3.4", 4), (3, "x 1.2.3.4", 4), (3, "other", 5)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, mark int")
    got = sorted(((r.doc_id, r.spans) for r in personal_data(docs).collect()), key=repr)
    want = [(None, "email:0:6"), (1, ""), (2, ""), (3, "ip:2:9"), (3, "ip:2:9"), (3, "")]
    assert got == sorted(want, key=repr)
    assert personal_data(docs.limit(0)).count() == 0
