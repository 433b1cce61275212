"""The Merkle manifest against a plain version and against SQL."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from blotter.llm import merkle
from blotter.llm.oracle import ORACLE
from blotter.llm.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(nodes, arity):
    """(root, siblings by leaf: (left, right) by level)."""
    ways = [[] for _ in nodes]
    owner = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for j, mine in enumerate(owner):
            run = j - j % arity
            for i in mine:
                ways[i].append(("".join(nodes[run:j]), "".join(nodes[j + 1 : run + arity])))
        cuts = range(0, len(nodes), arity)
        owner = [sum(owner[x : x + arity], []) for x in cuts]
        nodes = [h(*nodes[x : x + arity]) for x in cuts]
    return nodes[0], ways


def plain(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    held = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        held.append((own, *tree([leaf(*r) for r in own], arity)))
    root, above = tree([x[1] for x in held], arity)
    found = []
    for (own, subroot, ways), more in zip(held, above):
        for row, way in zip(own, ways):
            later = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                later = (*row[:4], row[4] + 1)
            node, way = leaf(*later), way + more
            for left, right in way:
                node = h(left, node, right)
            found.append((row[0], leaf(*row), subroot, root, h(*[x for s in way for x in s]), node, node == root))
    return sorted(found, key=repr)


def rows_of(docs, **options):
    later = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, {"n_chars": later}, **options)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


ROWS = [
    *[(i, f"text {i}", "en", "s", i) for i in range(70)],
    *[(i, "ü" * i, "de", None, None) for i in range(100, 103)],
    (200, None, "fr", "", 0),
    (201, "", None, "s", 5),
    (None, "no id", None, "s", 5),
    (None, None, None, None, None),
    (202, "=", "", "s", 1),
    (203, "mixed", "é", "s", 1),
    (203, "mixed", "é", "s", 1),
    (203, "other", "é", "s", 1),
    (204, "long " * 200_000, "z", "s", 1),
]


@pytest.mark.parametrize(("arity", "levels"), [(2, 8), (2, 1), (2, 2), (3, 1), (3, 2), (5, 2)])
def test_equals_plain_version(spark, arity, levels):
    docs = spark.createDataFrame(ROWS, KIND).withColumn("key", F.lit(1)).withColumn("_read", F.lit(2)).repartition(5)
    assert rows_of(docs, arity=arity, levels=levels) == plain(ROWS, arity)


def test_one_row_and_none(spark):
    row = (7, "alone", "en", "s", 5)
    assert rows_of(spark.createDataFrame([row], KIND)) == plain([row])
    assert plain([row])[0][4] == h()
    assert rows_of(spark.createDataFrame([], KIND)) == []


def test_many_equal_rows(spark):
    rows = [(1, "same", "en", "s", 4)] * 300 + [(2, "other", "en", "s", 5)]
    assert rows_of(spark.createDataFrame(rows, KIND), levels=3) == plain(rows)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op12_merkle_manifest"
    ours = spark_rows(QUERIES[name](spark, sf))
    assert ours == duck_rows(connect(sf), ORACLE[name])
    assert len(ours[1]) == 1000
