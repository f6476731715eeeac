import math
import random
import re
import zlib

import numpy as np

from tableflow.llm.quality import (
    BUCKETS,
    FOLD,
    MOST_BUCKETS,
    PRIOR,
    best_threshold,
    bucket_counts,
    bucket_number,
    features,
    fitted_threshold,
    judge_quality,
    log_ratios,
    score_quality,
)
from tableflow.llm.words import BETWEEN_SPACES, UNCHANGED, pieces, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, gram in enumerate(grams) if grams.count(gram) > 1 for j in range(3)} if len(words) < 500 else None
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, covered if covered is None else len(covered)


def test_base_counts_are_those_of_brute_force(spark, odd_docs, odd_texts):
    extra = "a b c a b c\nd %% é|ß\n \nd %% é|ß\nd %% é|ß \n" * 2
    texts = [*odd_texts, extra]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as score", "2 as n_words")
    rows = {r["doc_id"]: r for r in score_quality(docs, np.zeros(64)).collect()}
    for doc_id, text in enumerate(texts):
        expected = base(text)
        got = rows[doc_id]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"]) == expected[:4]
        if expected[4] is not None:
            assert got["n_repeat_words"] == expected[4]


def test_keeps_text_like_the_trusted_and_drops_the_rest(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(300):
        good = k % 3 > 0
        own = [f"{'word' if good else 'junk%%'}{rng.randrange(80)}" for _ in range(rng.randrange(60, 200))]
        rows.append((k, " ".join(own)))
        labels.append((k, int(good), 0))
    docs = spark.createDataFrame([*rows, (900, None), (901, "short"), (902, "same same " * 60)], "doc_id long, text string")
    table = spark.createDataFrame([l for l in labels if l[0] % 2] + [(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in judge_quality(docs, table).collect()}
    assert all(got[k]["kept"] == (k % 3 > 0) for k in range(300))
    assert not any(got[k]["kept"] for k in (900, 901, 902)) and all(got[k]["base_failed"] for k in (900, 901, 902))
    none = judge_quality(docs, table.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] and r["score"] == 0 for r in none)
    assert judge_quality(docs.limit(0), table).count() == 0


def test_every_document_counts_as_raw(spark):
    docs = spark.createDataFrame([(k, "a b c") for k in range(50)] + [(None, "a")], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (2,)], "doc_id long")
    rows = bucket_counts(docs, trusted, 16).collect()
    assert sum(r["raw"] for r in rows) == 50 * 8 + 2 and sum(r["target"] for r in rows) == 16
    assert log_ratios(bucket_counts(docs, trusted, 16), 16).shape == (16,)


def test_threshold_lies_between_the_kinds():
    assert best_threshold(np.array([1.0, 2.0]), np.array([-1.0, 0.0])) == 0.5
    assert best_threshold(np.array([1.0]), np.array([])) == 1.0
    assert best_threshold(np.array([]), np.array([1.0])) == float("-inf")


def test_threshold_of_a_table_is_that_of_arrays(spark):
    """Ties, repeated and negative scores, kinds apart and mixed, over several ranges and in one."""
    rng = random.Random(11)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for count, steps, shift in ((400, 30, 6), (400, 10**6, 10**5), (60, 5, 0), (3, 2, 9), (1, 1, 0)):
            rows = [(kind, (rng.randrange(steps) + shift * kind) / 7 - 3) for kind in (0, 1) for _ in range(count)]
            rng.shuffle(rows)
            for some in (rows, [r for r in rows if r[0]], [r for r in rows if not r[0]]):
                table = spark.createDataFrame(some, "quality int, score double").repartition(3)
                arrays = [np.array([score for kind, score in some if kind == side]) for side in (1, 0)]
                assert fitted_threshold(table) == best_threshold(*arrays)
        assert fitted_threshold(table.limit(0)) == float("-inf")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_the_threshold_is_fitted_on_every_labelled_document_of_the_fold(spark):
    """More than 20,000 good ones: the least score is that of the id that comes last by its hash."""
    ids = spark.range(84_000).withColumnRenamed("id", "doc_id")
    good = ids.where(f"crc32(cast(doc_id as string)) % 4 = {FOLD} or doc_id < 100")
    fold = good.where(f"crc32(cast(doc_id as string)) % 4 = {FOLD}")
    assert fold.count() > 20_000
    last = fold.selectExpr("max_by(doc_id, xxhash64(doc_id))").first()[0]
    usual, other = (" ".join(f"{letter}{k}" for k in range(50)) for letter in "wx")
    docs = good.selectExpr("doc_id", f"if(doc_id = {last}, '{other}', '{usual}') as text")
    unlabelled = spark.range(100_000, 103_000).selectExpr("id as doc_id", f"'{other}' as text")
    judged = judge_quality(docs.union(unlabelled), good.selectExpr("doc_id", "1 as quality"))
    assert judged.where("not kept").count() == 0
    assert judged.where(f"doc_id = {last}").first()["score"] < judged.where(f"doc_id <> {last}").first()["score"]


def test_buckets_grow_with_the_corpus():
    sizes = [bucket_number(n) for n in (0, 10**6, 10**9, 10**10, 10**12, 10**14)]
    assert sizes[0] == BUCKETS and sizes[-1] == MOST_BUCKETS and sizes == sorted(sizes) and len(set(sizes)) >= 4


def test_verdicts_are_those_of_brute_force(spark):
    """Counts, ratios, scores, threshold and verdicts with dictionaries; only the buckets' hashes are shared."""
    import pyarrow as pa

    rng = random.Random(4)
    rows, labels = [], []
    for k in range(240):
        good = rng.random() < 0.6
        own = [f"{'w' if rng.random() < (0.8 if good else 0.4) else 'j'}{rng.randrange(40)}" for _ in range(rng.randrange(20, 120))]
        rows.append((k, " ".join(own)))
        if k % 4:
            labels.append((k, int(good)))
    rows += [(300, None), (301, ""), (302, "x"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = spark.createDataFrame([*labels, (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    quality = {}
    for k, kind in [*labels, (6, 0)]:
        quality[k] = min(kind, quality.get(k, 1))
    buckets = []
    for _, text in rows:
        _, _, data, offsets = next(pieces(pa.array([text or ""])))
        buckets.append(features(words_of(data, offsets, BETWEEN_SPACES, UNCHANGED), BUCKETS)[1].tolist())
    held = {k: zlib.crc32(str(k).encode()) % 4 == FOLD for k in quality}
    raw, target = {}, {}
    for (k, _), own in zip(rows, buckets, strict=True):
        for b in own:
            raw[b] = raw.get(b, 0) + 1
            if quality.get(k) == 1 and not held[k]:
                target[b] = target.get(b, 0) + 1
    sums = sum(raw.values()) + PRIOR * BUCKETS, sum(target.values()) + PRIOR * BUCKETS
    ratio = {b: math.log((target.get(b, 0) + PRIOR) / sums[1]) - math.log((n + PRIOR) / sums[0]) for b, n in raw.items()}
    score = {k: sum(ratio[b] for b in own) / max(len(own), 1) for (k, _), own in zip(rows, buckets, strict=True)}
    failed = {}
    for k, text in rows:
        n_words, _, _, _, n_repeat = base(text)
        failed[k] = n_words < 50 or 100 * n_repeat > 50 * n_words
    fold = [np.array([score[k] for k, kind in quality.items() if held[k] and kind == side and not failed[k]]) for side in (1, 0)]
    assert min(map(len, fold)) > 5
    cut = best_threshold(*fold)
    got = judge_quality(docs, table).collect()
    assert len(got) == len(rows)
    for row in got:
        k = row["doc_id"]
        assert math.isclose(row["score"], score[k], abs_tol=1e-5) and row["base_failed"] == failed[k]
        if abs(score[k] - cut) > 1e-5:
            assert row["kept"] == (not failed[k] and score[k] >= cut)


def test_held_out_verdicts(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    outside = labels.where("crc32(cast(doc_id as string)) % 5 = 1")  # neither counted nor in the fold
    judged = judge_quality(docs, labels.join(outside.select("doc_id"), "doc_id", "left_anti"))
    rows = judged.where("not base_failed").join(outside, "doc_id").groupBy("quality", "kept").count().collect()
    found = {(row["quality"], row["kept"]): row["count"] for row in rows}
    assert found[1, True] >= 0.97 * (found[1, True] + found.get((1, False), 0))
    assert found.get((0, False), 0) >= 0.97 * (found.get((0, False), 0) + found.get((0, True), 0)) > 0
    print(found)


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "some more words " * 300_000), (2, "w " * 60)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in judge_quality(docs, none).collect()}
    assert got[1]["n_words"] == 900_000 == got[1]["n_repeat_words"] and got[1]["base_failed"]
