"""The rule cascade against SQL, plain counts, and its own order."""

from __future__ import annotations

import re

import pytest

from blotter.llm import rule_cascade
from blotter.llm.oracle import ORACLE
from blotter.llm.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows

KIND = "doc_id bigint, text string"
CLEAN = "the cat and the dog went to a house in the woods with a lamp that was as old as it is "


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    passages = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, p in enumerate(passages) if passages.count(p) > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "wide　blank and\x1cseparator\x85next no break",
    "a\n\na\na \n a\n",
    "x " * 40,
    "one two three four five six seven eight " * 2,
    "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 0",
    "#*$%&|<> ü€😀",
    CLEAN * 3,
    CLEAN.upper() * 3,
]


def test_counts_equal_plain_ones(spark):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TEXTS)], KIND + ", n_words int, kept int")
    found = {r["doc_id"]: tuple(r)[1:6] for r in rule_cascade.judge(docs).collect()}
    assert found == {i: plain_counts(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op11_rule_cascade"
    assert spark_rows(QUERIES[name](spark, sf)) == duck_rows(connect(sf), ORACLE[name])


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    judged = QUERIES["op11_rule_cascade"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    passed = judged.where("not base_failed")
    assert passed.where("quality = 1 and not kept").count() == 0
    bad = passed.where("quality = 0")
    assert bad.where("kept").count() < 0.03 * bad.count()


def test_order_by_rejections_per_cost(spark):
    def slow(text):
        return sum(range(20_000)) < 0 or "dog" in text.text

    rules = [
        rule_cascade.Rule("never", lambda t: False),
        rule_cascade.Rule("slow", slow),
        rule_cascade.Rule("quick", lambda t: "dog" in t.text),
        rule_cascade.Rule("rare", lambda t: "zebra" in t.text),
    ]
    rows = [(i, CLEAN + str(i) if i % 2 else CLEAN.replace("dog", "cow") + f"zebra {i}") for i in range(200)]
    rows += [(1000 + i, CLEAN.replace("dog", "cow") + str(i)) for i in range(200)]
    docs = spark.createDataFrame(rows, KIND)
    order = rule_cascade.estimated(docs, rules)
    assert {e.rule.name for e in order[:2]} == {"quick", "rare"}
    assert order[-1].rejected == order[-2].rejected == 0
    expected = {(r[0], r[7]) for r in rule_cascade.judge(docs, rules).collect()}
    assert expected == {(r[0], r[7]) for r in rule_cascade.judge(docs, rules[::-1], sample=10).collect()}


def test_short_circuit():
    asked = []
    rules = [rule_cascade.Rule(n, lambda t, n=n: asked.append(n) or n == "b") for n in "abc"]
    assert any(r.rejects(rule_cascade.Text(CLEAN)) for r in rules)
    assert asked == ["a", "b"]


def test_equal_hashes_are_settled_by_words(monkeypatch):
    monkeypatch.setattr(rule_cascade, "FACTORS", [0] * rule_cascade.PASSAGE)
    words = [str(i).encode() for i in range(30)] * 2
    assert rule_cascade.repeated_words(words) == 60
    assert rule_cascade.repeated_words(words[:30]) == 0


def test_empty_table_null_ids_repeated_rows_and_long_texts(spark):
    assert rule_cascade.judge(spark.createDataFrame([], KIND)).count() == 0
    long = " ".join(f"the w{i} and" for i in range(200_000))
    rows = [(None, CLEAN * 2), (None, CLEAN * 2), (2**60 + 1, long), (4, "y" * 100_000)]
    found = [tuple(r) for r in rule_cascade.judge(spark.createDataFrame(rows, KIND)).collect()]
    assert found[0] == found[1] and found[0][0] is None
    assert (found[2][0], found[2][1], found[2][5]) == (2**60 + 1, 600_000, 0)
    assert found[3][1] == 1 and found[3][6] and not found[3][7]
