import random

import numpy as np
import pyarrow as pa
import pytest

from tableflow.llm import minhash_forest
from tableflow.llm.minhash_forest import (
    LISTED,
    REGION,
    SHALLOW,
    TREES,
    WIDTH,
    ShingleSets,
    candidates,
    common_prefixes,
    near_duplicates,
)
from tableflow.llm.words import ASCII_LOWER, pieces


def shingles(text):
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 3]) for k in range(len(words) - 2))


def brute_force(rows):
    """(doc_id, n_shingles, component_id, kept) of rows that all have an id."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    root = {doc_id: doc_id for doc_id, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            common = len(one & two)
            if one and two and 100 * common >= 85 * len(one | two):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((doc_id, len(one), find(doc_id), find(doc_id) == doc_id) for doc_id, one in sets)


def rows_of(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, near_duplicates(frame.repartition(parts)).collect()))


def test_components_are_those_of_brute_force(odd_docs, odd_texts):
    got = near_duplicates(odd_docs).collect()
    assert sorted(map(tuple, got)) == brute_force(list(enumerate(odd_texts)))


def test_links_near_the_threshold(spark):
    rng = random.Random(21)
    rows = []
    for size in [*range(1, 30), 40, 60, 97, 150, 367, 900]:
        words = [f"a{rng.randrange(10**6)}" for _ in range(size)]
        rows.append(" ".join(words))
        for share in (12, 13, 14, 20):
            cut = size // share
            rows.append(" ".join(words[cut:]))
            rows.append(" ".join([*words, *[f"c{rng.randrange(10**6)}" for _ in range(cut)]]))
            rows.append(" ".join([*words[: size // 2], *[f"d{rng.randrange(10**6)}" for _ in range(cut)], *words[size // 2 + cut :]]))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert rows_of(spark, rows) == brute_force(rows)


def test_pairs_inside_a_dense_region(spark):
    """Texts that share half of their words with all others, some of them near copies."""
    rng = random.Random(22)
    shared = [f"s{k}" for k in range(60)]
    rows = []
    for _ in range(400):
        own = [f"o{rng.randrange(10**6)}" for _ in range(50)]
        rows.append(" ".join(shared + own))
        if rng.random() < 0.3:
            own[rng.randrange(50)] = "changed"
            rows.append(" ".join(shared + own))
    rows = list(enumerate(rows))
    got, want = rows_of(spark, rows), brute_force(rows)
    linked = [row for row in want if not row[3]]
    found = set(got) & set(linked)
    assert len(found) >= 0.99 * len(linked) > 50
    assert {row for row in got if not row[3]} <= set(linked)


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(23)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for doc_id in range(3000):
        own = list(words)
        own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((doc_id, " ".join(own)))
    got = rows_of(spark, rows, 8)
    assert [row[2] for row in got] == [0] * 3000 and sum(row[3] for row in got) == 1


@pytest.mark.parametrize("block", [minhash_forest.BLOCK, 100])
def test_members_of_a_crowd_that_are_like_one_of_it_only(spark, monkeypatch, block):
    """A text, many copies of it with 4 changes, and as many with 8: these are like the text itself and no other."""
    monkeypatch.setattr(minhash_forest, "BLOCK", block)
    rng = random.Random(25)
    words = [f"w{k}" for k in range(300)]

    def changed(count):
        own = list(words)
        for at in rng.sample(range(1, 100), count):  # no two next to each other
            own[3 * at] = f"x{rng.randrange(10**9)}"
        return " ".join(own)

    near, far = [changed(4) for _ in range(300)], [changed(8) for _ in range(300)]
    rows = list(enumerate([" ".join(words), *near, *far]))
    some = [*rows[:30], *rows[-30:]]
    assert all(row[2] == 0 for row in brute_force(some))
    assert all(row[3] for row in brute_force(some[1:])[-30:])
    got = rows_of(spark, rows, 4)
    assert all(row[2] == 0 for row in got[:301])
    assert sum(row[2] == 0 for row in got[301:]) >= 297  # each by one pair, which misses all trees with a chance of 0.3 %


def test_a_crowd_has_one_name_in_all_its_parts():
    labels = np.zeros((3 * REGION, WIDTH), np.uint8)
    labels[-2:, -1] = 1, 2
    _, _, _, members, regions = candidates(labels)
    assert members.tolist() == list(range(3 * REGION - 2))
    assert set(regions.tolist()) == set(candidates(labels[REGION:])[4].tolist()) and len(set(regions.tolist())) == 1


def test_near_pairs_of_a_region_and_of_tiles(spark):
    """Classes with sketches of two widths, compared with all others or across two sides."""
    rng = random.Random(26)
    rows = []
    for name in range(120):
        size = rng.choice([60, 66, 500])
        parts = [-1 if rng.random() < 0.9 else rng.randrange(2**62) for _ in range(1 << (size > 63))]
        rows.append((name, rng.randrange(4), size, parts))

    def possible(a, b):
        small, large = sorted((a[3], b[3]), key=len)
        if len(small) < len(large):
            large = [large[0] ^ large[1]]
        apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(small, large))
        total = a[2] + b[2]
        alike = 20 * a[2] >= 17 * b[2] and 20 * b[2] >= 17 * a[2]
        return a[1] != b[1] and alike and apart <= total - 2 * -(-17 * total // 37)

    def found(sides):
        full = [(9, *row, side) for row, side in zip(rows, sides)]
        frame = spark.createDataFrame(full, "region long, class long, root long, n_shingles long, sketch array<long>, side long")
        return sorted(map(tuple, minhash_forest._near_pairs(frame).distinct().collect()))

    every = [(a[0], b[0]) for k, b in enumerate(rows) for a in rows[:k] if possible(a, b)]
    assert found([0] * 120) == sorted(every) and len(every) > 100
    across = [(a, b) for a, b in every if a % 2 != b % 2]
    assert found([1 + k % 2 for k in range(120)]) == sorted(across)


def test_missing_and_repeated_ids(spark):
    long_, other = " ".join(f"w{k}" for k in range(50)), " ".join(f"v{k}" for k in range(50))
    rows = [(5, long_), (5, long_), (None, long_ + " more"), (7, other), (7, "short text"), (9, "short text")]
    rows += [(None, "no id at all"), (None, "no id at all"), (None, None), (3, ""), (4, None), (4, " \n ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as label", "3 as class")
    got = sorted(((row["doc_id"], row["component_id"], row["kept"]) for row in near_duplicates(frame).collect()), key=str)
    want = [(5, 5, True)] * 2 + [(None, 5, False), (7, 7, True), (7, 7, True), (9, 7, False)]
    want += [(None, None, True)] * 3 + [(3, 3, True), (4, 4, True), (4, 4, True)]
    assert got == sorted(want, key=str)


def test_empty_table(spark, no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_many_equal_rows_without_an_id(spark):
    rows = [(None, "the same short text again")] * 5000 + [(1, "the same short text again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(frame).groupBy("component_id", "kept").count().collect()
    assert sorted(tuple(row) for row in got) == [(1, False, 5000), (1, True, 1)]


def test_labels_agree_like_sets():
    rng = random.Random(24)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    texts = pa.array([" ".join(words), " ".join(words[:1800]), "other words here"])
    _, _, data, offsets = next(pieces(texts, 1 << 30))
    labels = ShingleSets(data, offsets).labels(np.arange(3))
    assert labels.shape == (3, TREES, WIDTH)
    deep = common_prefixes(np.stack([labels[0], labels[1]], 1).reshape(-1, WIDTH))[::2]
    assert abs((deep >= SHALLOW).mean() - 0.9**SHALLOW) < 0.3
    other = common_prefixes(np.stack([labels[0], labels[2]], 1).reshape(-1, WIDTH))[::2]
    assert not other.any()


@pytest.mark.parametrize("size", [2, LISTED, LISTED + 1, REGION, REGION + 1, 250])
def test_candidates_of_a_run_are_bounded(size):
    labels = np.zeros((size, WIDTH), np.uint8)
    labels[:, -1] = np.arange(size)
    one, two, direct, members, regions = candidates(labels)
    pairs = set(zip(one.tolist(), two.tolist()))
    assert len(pairs) == len(one) <= size * LISTED
    assert {(k, k + 1) for k in range(size - 1)} <= pairs and direct.sum() == size - 1
    if size <= LISTED:
        assert len(pairs) == size * (size - 1) // 2
    if LISTED < size <= REGION:
        assert members.tolist() == list(range(size)) and len(set(regions.tolist())) == 1
    else:
        assert len(members) == 0
