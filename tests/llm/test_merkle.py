"""Roots, proofs and log places against trees built in plain lists; odd rows."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from conftest import SF_DIR

from tidemark.llm import merkle
from tidemark.llm.common import documents

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    """All levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def steps_of(levels, index):
    for level in levels[:-1]:
        first = index - index % 3
        run = level[first : first + 3]
        yield index - first, run[: index - first] + run[index - first + 1 :]
        index //= 3


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row, leaf(*row)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name, group in sources.items():
        group.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[name] = levels_of([x[1] for x in group])
    top = levels_of([trees[name][-1][0] for name in names])
    out = []
    for name in names:
        for i, (row, node) in enumerate(sources[name]):
            steps = [*steps_of(trees[name], i), *steps_of(top, names.index(name))]
            text = row[4]
            if row[0] is not None and crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf(*row[:4], text)
            for at, others in steps:
                folded = digest(*others[:at], folded, *others[at:])
            proof = digest(*(o for _, others in steps for o in others))
            out.append(
                (row[0], node, trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0])
            )
    return sorted(out, key=repr), trees


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def check(spark, rows, levels=merkle.BLOCK_LEVELS):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle.proofs(docs, levels).select(*COLUMNS).collect()
    want, trees = brute(rows)
    assert sorted(map(tuple, got), key=repr) == want
    return docs, trees


def test_whole_table(spark):
    table = documents(spark, SF_DIR).select(*COLUMNS[:1], "source", "lang", "n_chars", "text")
    check(spark, [tuple(r) for r in table.collect()])


@pytest.mark.parametrize("levels", [1, 2])
def test_several_layers_of_blocks(spark, levels):
    """Blocks of 3 and 9 leaves, so that a small table has all layers a large one has."""
    rng = random.Random(levels)
    rows = []
    for i in range(400):
        source = rng.choice(["hot", "hot", "b", "ü", None, f"s{rng.randrange(12)}"])
        rows.append((i * 7, source, "en", i, rng.choice(["a\nb", "c", "", None, "\n"])))
    docs, trees = check(spark, rows, levels)
    logs = {}
    for r in merkle.manifest(docs, levels).sources.log().collect():
        logs.setdefault(r.part, {})[r.place] = (r.level, r.digest)
    for source, tree in trees.items():
        assert logs[source] == dict(enumerate(postorder(tree)))


def postorder(levels):
    out = []

    def visit(level, index):
        if level:
            for child in range(3 * index, min(3 * index + 3, len(levels[level - 1]))):
                visit(level - 1, child)
        out.append((level, levels[level][index]))

    visit(len(levels) - 1, 0)
    return out


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 9, 10, 27, 28, 31, 82, 100])
def test_places_are_those_of_the_completion_order(leaves):
    nodes = [bytes([i]) * 32 for i in range(leaves)]
    height = merkle.height_of(leaves)
    log = merkle.append_log(nodes, height)
    levels = levels_of([n.hex() for n in nodes])
    places = [
        merkle.position(level, i, leaves) for level in range(height + 1) for i in range(len(levels[level]))
    ]
    assert sorted(places) == list(range(len(log)))
    assert [x.hex() for x in log] == [node for _, node in postorder(levels)]
    for level in range(height + 1):
        for i, node in enumerate(levels[level]):
            assert log[merkle.position(level, i, leaves)].hex() == node


def test_odd_rows(spark):
    """NULLs in every column, equal rows, ties of doc_id, empty and very long texts."""
    rows = [
        (None, None, None, None, None),
        (2, None, "en", 1, "x\ny"),
        (2, None, "en", 1, "x\ny"),
        (2, None, "en", 1, "other\n"),
        (None, "s", "en", 3, "a\nb"),
        (5, "s", None, None, ""),
        (6, "", "de", 0, "long \n" * 200_000),
        (-4, "s", "en", 2**40, "ä\n€\n𝄞"),
    ]
    check(spark, rows)


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 1, "one\ntwo") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    verified = {r.doc_id: r.verified for r in merkle.proofs(docs).collect()}
    assert verified == {i: crc32(str(i).encode()) % 2 != 0 for i in range(50)}


def test_empty_table_and_further_columns(spark):
    assert merkle.proofs(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(i, "s", "en", 1, "t") for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    more = docs
    for name in ("part", "leaf", "rank", "total", "block", "root", "path", "id", "changed", "of"):
        more = more.withColumn(name, merkle.F.lit("x"))
    plain = sorted(map(tuple, merkle.proofs(docs).collect()))
    assert sorted(map(tuple, merkle.proofs(more).collect())) == plain
