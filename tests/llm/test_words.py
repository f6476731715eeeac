import numpy as np
import pyarrow as pa

from tableflow.llm.words import (
    BETWEEN_SPACES,
    LETTERS_AND_DIGITS,
    LOWER,
    UNCHANGED,
    gram_hashes,
    pieces,
    repeated,
    sliding_min,
    words_of,
)


def test_words_are_those_of_the_patterns(odd_texts):
    import re

    column = pa.array(odd_texts)
    for kind, case, pattern, low in (
        (BETWEEN_SPACES, UNCHANGED, r"[^\x20\x09-\x0D]+", False),
        (LETTERS_AND_DIGITS, LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
    ):
        names, seen = {}, 0
        for begin, end, data, offsets in pieces(column, 300):
            words = words_of(data, offsets, kind, case)
            for row in range(begin, end):
                text = odd_texts[row] or ""
                if low:
                    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                expected = re.findall(pattern, text)
                mine = slice(words.first[row - begin], words.first[row - begin + 1])
                hashes = words.hashes[mine].tolist()
                assert len(hashes) == len(expected)
                for word, value in zip(expected, hashes):
                    assert names.setdefault(word, value) == value
                seen += 1
        assert seen == len(odd_texts)
        assert len(set(names.values())) == len(names)


def test_pieces_of_a_slice_and_of_nothing():
    column = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    rows = [(b, e, data.tobytes(), off.tolist()) for b, e, data, off in pieces(column, 2)]
    assert [r[0] for r in rows][0] == 0 and rows[-1][1] == 3
    assert b"".join(r[2] for r in rows) == b"cd e f"
    assert list(pieces(pa.array([], pa.string()))) == []


def test_prefixes_count_code_points():
    texts = ["réeux réeuxment ré abcd ABCDE"]
    _, _, data, offsets = next(pieces(pa.array(texts)))
    words = words_of(data, offsets, LETTERS_AND_DIGITS, LOWER, with_sums=True)
    longer, hashes = words.prefixes(4)
    assert longer.tolist() == [0, 1, 4]
    assert hashes[0] == hashes[1] != hashes[2]


def test_sliding_min_and_repeated():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 200).astype(np.uint64)
    for length in (1, 2, 5, 13, 200, 201):
        expected = [values[i : i + length].min() for i in range(len(values) - length + 1)]
        assert sliding_min(values, length).tolist() == expected
    counts = {v: (values == v).sum() for v in set(values.tolist())}
    assert repeated(values).tolist() == [counts[v] > 1 for v in values.tolist()]
    same = gram_hashes(np.array([1, 2, 3, 1, 2, 3, 4], np.uint64), 3)
    assert same[0] == same[3] and len(set(same.tolist())) == 4
