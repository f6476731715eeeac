import re

import pytest

from brute import contamination, words
from tableflow.llm.decontamination import find_contamination

ITEMS = [
    (1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "one two three"),
    (3, "solo"),
    (10, "the the the the the the the the the the the the the the"),
    (11, "É é über-groß ça va 1 2 3 4 5 6 7 8 9"),
    (12, None),
    (13, "..."),
    (None, "no id here"),
    (2, "one two three"),
]
DOCS = [
    (0, "x " * 30 + "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
    (1, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
    (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (3, "one two THREE, one two three " + "pad " * 200),
    (4, "solo"),
    (5, None),
    (6, ""),
    (7, "the " * 300),
    (8, "é é über groß ça va 1 2 3 4 5 6 7 8 9 9"),
    (9, "no id here"),
    (4, "solo"),
    (4, "other text of the id"),
    (None, "one two three"),
]


@pytest.mark.parametrize("window", [13, 5, 1, 40])
def test_hits_are_those_of_contamination(spark, window):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as words", "2 as print", "3 as hit")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as span")
    got = find_contamination(docs.repartition(3), items, window)
    got = got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert sorted(map(tuple, got), key=str) == contamination(DOCS, ITEMS, window)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tableflow.llm.decontamination.BROADCAST_ROWS", 0)
    docs, items = (spark.createDataFrame(r, f"{n} long, text string") for r, n in ((DOCS, "doc_id"), (ITEMS, "item_id")))
    got = find_contamination(docs, items).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert sorted(map(tuple, got), key=str) == contamination(DOCS, ITEMS, 13)


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert find_contamination(no_docs, items).count() == 0
    got = find_contamination(docs, items.limit(0))
    assert got.count() == len(DOCS) and got.where("contaminated or n_hit > 0").count() == 0


def test_no_python_runs_on_the_executors(spark):
    docs, items = (spark.createDataFrame(r, f"{n} long, text string") for r, n in ((DOCS, "doc_id"), (ITEMS, "item_id")))
    plan = find_contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_repetitive_text_of_many_words(spark):
    """A place for each word, not an array of places for each of them."""
    docs = spark.createDataFrame([(1, "aa " * 300_000), (2, "bb " + "aa " * 12), (3, "aa " * 14 + "bb")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "aa " * 60), (8, "aa " * 13 + "bb")], "item_id long, text string")
    got = sorted(tuple(r) for r in find_contamination(docs, items).select("doc_id", "n_hit", "items").collect())
    assert got == [(1, 300_000, ["7", "8"]), (2, 0, []), (3, 15, ["7", "8"])]
