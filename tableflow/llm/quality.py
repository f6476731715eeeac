"""Quality rules and a log-likelihood ratio of hashed n-grams between trusted and raw text.

Word unigrams, word bigrams and the last three bytes of words fall into buckets, whose number grows with the
corpus (``bucket_number``). Over the buckets there are two multinomials: of trusted documents, and of the whole
corpus. A document's score is the mean of log(trusted / raw) over its n-grams, so length does not
count; it is kept if the score reaches a threshold, the one that best parts labelled good documents
from labelled bad ones. The verdict is a function of the text, the two tables and the threshold,
with no random choice.

The raw multinomial counts every document, the trusted one every document labelled good whose id does not fall
into the threshold's fold. The threshold is fitted on all labelled documents of that fold, which the counts have not seen,
by running sums over ranges of their scores: of any number of documents the driver gets two rows. Each task that counts
sends one row per bucket at most. Every text is scored once, and the scores are kept in the checkpoint folder.

Defined cases: a null or wordless text has no words, score 0 and fails the base rules; every row is
judged, repeated ones alike; without trusted documents every ratio is 0 and only the base rules
decide; without bad ones the threshold is the least good score of the fold, without good ones there is none. A
document labelled both ways is bad. Scores equal to the threshold are kept; of several cuts that part the fold equally
well the lowest counts. A very long text is judged whole by one task, with some 50 bytes a word. Extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.shared import broadcast_if_small, ready, stored
from tableflow.llm.words import (
    BETWEEN_SPACES,
    UNCHANGED,
    Words,
    gram_hashes,
    mixed,
    pieces,
    repeated,
    sums_by_text,
    words_of,
)

#: least and greatest number of buckets, and their number for each square root of the corpus' bytes: each task sends a
#: row per bucket, so that what is shuffled would outgrow the corpus if their number grew like it. Tables of the
#: greatest size, that of 2 TB of text, take 64 MB of a worker while it counts
BUCKETS = 1 << 15
MOST_BUCKETS = 1 << 22
BUCKETS_A_ROOT = 3
#: the fold whose labelled documents the threshold is fitted on: crc32(id) % 4
FOLD = 3
#: added to each bucket's count, so that no ratio is infinite
PRIOR = 1.0

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_LINE = _BYTES != 0x0A
_POINT = (_BYTES & 0xC0) != 0x80


def base_counts(words: Words, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The rules' counts of each text of a piece."""
    data = words.data
    inside = BETWEEN_SPACES[data]
    lines = words_of(data, offsets, _LINE, UNCHANGED)
    filled = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    with_word = filled[lines.ends] > filled[lines.starts]
    text = lines.text_of()[with_word]
    keys = lines.hashes[with_word] ^ mixed(text.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order][1:] == keys[order][:-1]
    duplicates = np.bincount(text[again], minlength=len(offsets) - 1)
    covered = np.zeros(len(words.starts), bool)
    starts = words.starts_with_room(3)
    if len(starts):
        own = words.text_of()[starts].astype(np.uint64)
        twice = starts[repeated(gram_hashes(words.hashes, 3)[starts] ^ mixed(own))]
        for k in range(3):
            covered[twice + k] = True
    return {
        "n_words": words.counts(),
        "word_chars": sums_by_text(inside & _POINT[data], offsets),
        "n_symbols": sums_by_text(_SYMBOL[data], offsets),
        "n_dup_lines": duplicates,
        "n_repeat_words": sums_by_text(covered, words.first),
    }


def bucket_number(text_bytes: int) -> int:
    """A number that grows with the square root of the corpus."""
    return min(max(BUCKETS, BUCKETS_A_ROOT * math.isqrt(text_bytes)), MOST_BUCKETS)


def in_fold(name: str = "doc_id"):
    return F.crc32(F.col(name).cast("string")) % 4 == FOLD


def features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every hashed n-gram of a piece."""
    text = words.text_of()
    starts = words.starts_with_room(2)
    pairs = gram_hashes(words.hashes, 2)[starts] if len(starts) else words.hashes[:0]
    tail = np.zeros(len(text), np.uint64)
    for k in range(1, 4):
        at = words.ends - k
        byte = np.where(at >= words.starts, words.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
        tail = tail * np.uint64(257) + byte if len(text) else tail
    size = np.uint64(buckets)
    grams = np.concatenate([words.hashes, mixed(pairs + np.uint64(1)), mixed(tail + np.uint64(1 << 40))])
    return np.concatenate([text, text[starts], text]), (grams % size).astype(np.int64)


def _count_rows(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            mark = batch.column("trusted").to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in pieces(batch.column("text")):
                text, bucket = features(words_of(data, offsets, BETWEEN_SPACES, UNCHANGED), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                trusted += np.bincount(bucket[mark[begin:end][text]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(trusted[seen])], ["bucket", "raw", "target"]
        )

    return rows


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw, target: n-grams of all of ``docs`` and of those whose id ``trusted`` has.

    ``trusted`` is broadcast while it is counted to be small.
    """
    marks = trusted.select(F.col("doc_id").alias("trusted_id")).distinct().withColumn("trusted", F.lit(True))
    marked = docs.select("doc_id", "text").join(
        broadcast_if_small(stored(marks)), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    marked = marked.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = marked.mapInArrow(_count_rows(buckets), "bucket int, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log(trusted / raw) of each bucket: a table of fixed size."""
    raw, target = np.full(buckets, PRIOR), np.full(buckets, PRIOR)
    rows = counts.toArrow()
    at = rows.column("bucket").to_numpy()
    raw[at] += rows.column("raw").to_numpy()
    target[at] += rows.column("target").to_numpy()
    if target.sum() == PRIOR * buckets:
        return np.zeros(buckets)
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def _score_rows(table: Broadcast):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = table.value
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column("text")):
                words = words_of(data, offsets, BETWEEN_SPACES, UNCHANGED)
                columns = base_counts(words, offsets)
                text, bucket = features(words, len(ratios))
                count = np.bincount(text, minlength=end - begin)
                total = np.bincount(text, ratios[bucket], minlength=end - begin)
                score = total / np.maximum(count, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        *[pa.array(values, pa.int64()) for values in columns.values()],
                        pa.array(score, pa.float64()),
                    ],
                    ["doc_id", *columns, "score"],
                )

    return rows


SCORED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
)


def score_quality(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, the rules' counts and the mean log ratio of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = ready(docs.sparkSession).sparkContext.broadcast(ratios)  # lives as long as the result
    return texts.mapInArrow(_score_rows(table), SCORED)


def best_threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the greatest share of good scores at or above it less that of bad ones.

    Between the scores that give this, the cut is in the middle; without bad scores it is the least
    good one, without good ones there is none.
    """
    if not len(good):
        return float("-inf")
    if not len(bad):
        return float(good.min())
    cuts = np.unique(np.concatenate([good, bad]))
    above_good = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
    above_bad = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    best = int(np.argmax(np.round(above_good - above_bad, 12)))
    return float(cuts[best] if best == 0 else (cuts[best - 1] + cuts[best]) / 2)


def fitted_threshold(scores: DataFrame) -> float:
    """``best_threshold`` of a table of any size with columns quality (1 or 0) and score.

    The distinct scores are dealt out by ranges. What is below a score are the sums of the ranges before its own, of
    which there is a row each, and those inside its own.
    """
    kinds = [F.sum(F.when(F.col("quality") == kind, 1).otherwise(0)).alias(name) for kind, name in ((1, "good"), (0, "bad"))]
    cuts = scores.groupBy("score").agg(*kinds)
    cuts = stored(cuts.repartitionByRange("score").withColumn("part", F.spark_partition_id()))
    good, bad, least = cuts.agg(F.sum("good"), F.sum("bad"), F.min("score")).first()
    if not good:
        return float("-inf")
    if not bad:
        return least
    ranges, inside = Window.orderBy("least"), Window.partitionBy("part").orderBy("score")

    def below(name: str, window):
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    parts = cuts.groupBy("part").agg(
        F.min("score").alias("least"), F.max("score").alias("most"), *[F.sum(name).alias(name) for name in ("good", "bad")]
    )
    parts = parts.select(
        "part",
        F.lag("most").over(ranges).alias("most_before"),
        below("good", ranges).alias("good_before"),
        below("bad", ranges).alias("bad_before"),
    )
    rows = cuts.join(F.broadcast(parts), "part").select(
        "score",
        F.coalesce(F.lag("score").over(inside), "most_before").alias("before"),
        (F.col("good_before") + below("good", inside)).cast("decimal(18,0)").alias("good_below"),
        (F.col("bad_before") + below("bad", inside)).cast("decimal(18,0)").alias("bad_below"),
    )
    # the share of good scores at or above less that of bad ones, times both numbers: exact
    gain = F.col("bad_below") * F.lit(good) - F.col("good_below") * F.lit(bad)
    cut, before = rows.orderBy(gain.desc(), "score").select("score", "before").first()
    return cut if before is None else (before + cut) / 2


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_quality`` with base_failed and kept; ``labels``: doc_id, quality (1: good, 0: bad)."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
    marks = marks.agg(F.min("quality").alias("quality"))
    counted = marks.where((F.col("quality") == 1) & ~in_fold())
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = bucket_number(size)
    ratios = log_ratios(bucket_counts(docs, counted.select("doc_id"), buckets), buckets)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = stored(score_quality(docs, ratios).withColumn("base_failed", base_failed))
    # equal rows of one id give equal scores
    fold = scored.where(in_fold() & ~F.col("base_failed")).select("doc_id", "score").distinct()
    known = broadcast_if_small(stored(marks.where(in_fold() & F.col("quality").isin(0, 1))))
    threshold = fitted_threshold(fold.join(known, "doc_id"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def op3_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return judge_quality(docs, labels)
