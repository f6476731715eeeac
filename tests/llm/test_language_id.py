import numpy as np
import pytest

from tableflow.llm.language_id import Alphabet, Runs, identify_languages, letter_vectors, op7_language_id, prototypes


def direct(text, dimensions):
    """The bundle, letter run by letter run."""
    letters, last = [0], True
    for c in text:
        if c.isalpha():
            letters.append(ord(c.lower()[0]))
            last = False
        elif not last:
            letters.append(0)
            last = True
    if not last:
        letters.append(0)
    own = {x: letter_vectors(np.array([x]), dimensions)[0] for x in set(letters)}
    total = np.zeros(dimensions)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(own[a], 2) * np.roll(own[b], 1) * own[c]
    return total


def test_bundles_are_those_of_brute_force():
    texts = ["The cat, the hat!", "", "  ", "É", "ab", "日本語 テキスト", "x1y2z3 " * 50, "a  b\n\nc"]
    runs = Runs(texts, Alphabet())
    got = runs.bundles(np.arange(len(texts)), len(texts), 128)
    for text, row in zip(texts, got):
        assert np.array_equal(row, direct(text, 128)), text
    assert runs.has_letter.tolist() == [any(c.isalpha() for c in t) for t in texts]
    joint = runs.bundles(np.zeros(len(texts), np.int64), 1, 128)
    assert np.array_equal(joint[0], got.sum(0))


def test_letter_vectors_are_balanced_and_nearly_orthogonal():
    vectors = letter_vectors(np.arange(97, 123), 1024)
    cosines = vectors @ vectors.T / 1024
    assert set(np.unique(vectors)) == {-1, 1} and np.abs(cosines - np.eye(26)).max() < 0.2


def test_odd_texts_and_nothing_learned(spark, no_docs):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, None, "en"), (4, "123", None), (5, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0 as score")
    names, table = prototypes(docs)
    assert names == ["en", "fr"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_languages(docs, names, table).collect()}
    assert got[1][0] == "en" and got[2][0] == "fr" and got[3] == got[4] == got[5] == ("und", 0.0)
    names, table = prototypes(no_docs)
    assert names == [] and {r["lang_pred"] for r in identify_languages(docs, names, table).collect()} == {"und"}
    assert identify_languages(no_docs, names, table).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op7_language_id(spark, sf_dir).where("held_out").join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() / got.count() >= 0.99


def test_repeated_rows_ties_and_a_very_long_text(spark):
    rows = [(1, "aaa bbb", "b"), (1, "aaa bbb", "b"), (2, "aaa bbb", "a"), (3, "ccc ddd", "c"), (4, "ccc ddd " * 150_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, table = prototypes(docs)
    assert names == ["a", "b", "c"] and np.allclose(table[0], table[1])  # twice the same is the same direction
    got = {r["doc_id"]: r["lang_pred"] for r in identify_languages(docs, names, table).collect()}
    assert got == {1: "a", 2: "a", 3: "c", 4: "c"}


def test_a_column_that_holds_no_languages_is_refused(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'some text' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError, match="languages"):
        prototypes(docs)
