import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def invented(rng, count, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="session")
def odd_texts():
    """Copies, near copies, shared passages, repeats, odd white space, short, empty and null texts."""
    rng = random.Random(7)
    base = [invented(rng, rng.randrange(30, 200)) for _ in range(40)]
    passage = invented(rng, 40)
    texts = [" ".join(words) for words in base]
    texts += [" ".join(base[k]) for k in range(8) for _ in range(3)]
    texts += [" ".join(edited(rng, base[k], 1 + k % 4)) for k in range(20)]
    texts += ["\t".join(invented(rng, 20)) + "\n" + " ".join(passage[k % 5 :]) for k in range(15)]
    texts += ["Aa bb " * 40, "aa BB " * 40, "one", "one two", "One two three", "", "   ", None, None, "x\n\nx\ny\nX "]
    texts += ["É é ÉÉ " + " ".join(base[0]), " ".join(base[3]) + "\r\n" + " ".join(base[3])]
    texts += [" ".join(invented(rng, 6000, 50))]
    return texts


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rows = [(k, text, "en", f"s{k % 3}", len(text or "")) for k, text in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, COLUMNS)
    # names that operators use inside
    return docs.selectExpr("*", "1 as id", "'k' as key", "2 as copies", "true as hit", "'r' as row").repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
