import hashlib

import numpy as np
import pytest

from tableflow.llm.fm_index import FmIndex, WaveletMatrix
from tableflow.llm.substring_dedup import op1_substring_dedup, remove_repeats


def brute_force(rows, window):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda row: row[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = b" ".join(word for word, drop in zip(words, gone) if not drop)
        out.append((doc_id, len(words), sum(gone), kept))
    return out


@pytest.mark.parametrize("window,gram,options", [
    (20, 8, {}),
    (5, 3, {"split_anchor": 1, "shard_words": 50}),
    (6, 1, {"shard_words": 1}),
    (2, 1, {}),
])
def test_removes_what_brute_force_removes(odd_docs, odd_texts, window, gram, options):
    got = remove_repeats(odd_docs, window, gram, **options).collect()
    expected = brute_force(list(enumerate(odd_texts)), window)
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == expected
    assert sum(row[2] for row in expected) > 100


def test_ids_that_are_null_or_repeat(spark):
    words = " ".join(f"w{k}" for k in range(8))
    rows = [(None, words), (1, words), (1, words), (2, "x " + words), (2, words + " y"), (3, None), (3, "")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 4, 2).collect()
    found = sorted(((r[0] is not None, r[0] or 0, r[1], r[2]) for r in got))
    assert found == [
        (False, 0, 8, 0),
        (True, 1, 8, 8), (True, 1, 8, 8),
        (True, 2, 9, 8), (True, 2, 9, 8),
        (True, 3, 0, 0), (True, 3, 0, 0),
    ]


def test_empty_table(no_docs):
    assert remove_repeats(no_docs).count() == 0


def test_anchors_must_fit_the_window(no_docs):
    with pytest.raises(ValueError):
        remove_repeats(no_docs, 8, 8)


def test_query_on_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = [(*row[:3], hashlib.sha256(row[3]).hexdigest()) for row in brute_force(rows, 20)]
    got = op1_substring_dedup(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(row) for row in got] == expected


def test_rank_of_the_wavelet_matrix():
    symbols = np.random.default_rng(3).integers(0, 37, 500)
    matrix = WaveletMatrix(symbols, 37)
    for at in (0, 1, 63, 64, 65, 250, 500):
        expected = [(symbols[:at] == s).sum() for s in range(37)]
        assert matrix.rank(np.arange(37), np.full(37, at)).tolist() == expected


def test_occurrences_and_windows_of_the_index():
    rng = np.random.default_rng(4)
    rows = [rng.integers(1, 4, size).tolist() for size in rng.integers(1, 30, 40)]
    text = np.array([x for row in rows for x in [*row, 0]])
    for depth in (2, 4, 5, 8):
        index = FmIndex(text, depth)
        for row in rows[:10]:
            for size in range(1, min(depth, len(row)) + 1):
                pattern = row[:size]
                expected = sum(other[i : i + size] == pattern for other in rows for i in range(len(other)))
                assert index.occurrences(np.array(pattern)) == expected
        firsts = np.cumsum([0, *[len(row) + 1 for row in rows[:-1]]])
        group = index.stream(firsts, np.array([len(row) for row in rows]))
        seen = {}
        for first, row in zip(firsts.tolist(), rows):
            for at in range(len(row)):
                if at + depth <= len(row):
                    assert seen.setdefault(tuple(row[at : at + depth]), group[first + at]) == group[first + at]
                else:
                    assert group[first + at] == -1
        assert len(set(seen.values())) == len(seen)


