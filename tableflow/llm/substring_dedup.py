"""Substring dedup: words covered by a window of words that also starts earlier in the corpus.

Equal windows meet without comparing documents: a window's *anchor* is the least hash among its
word 8-grams, so equal windows have equal anchors, and neighbouring windows that share an anchor
occurrence travel as one *segment*. Only segments whose anchor occurs twice are shipped. Each task
takes whole anchors, builds a compressed FM-index of their segments (a shard of bounded size) and
streams the segments through it: matching statistics give the interval of every window, and the
interval's earliest occurrence tells which windows are repeats.

Words are told apart by 40 bits of their hashes there: windows that differ in a single word pass for
equal with a chance of 2^-40. Copies of a whole text are found by hash before that and never shipped.
What occurs several times in one batch travels once. An anchor with very many different contexts is
split by whole windows, so no key gathers more than a bounded number of rows from a batch, and no group
of one key is more than the batches have sent.

Defined cases: a null text has no words; a null id comes before all others; rows with equal id and
text are one document, reported once per row; rows with equal id and other text are documents of
their own whose windows start at the same place, none earlier. Extra columns are ignored. Rows should
come in a fixed order within a partition, as from files, so that a task that is run again does the same. A very long
text is one array of its task, with some 50 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.fm_index import FmIndex
from tableflow.llm.shared import order_id, stored, whole_groups
from tableflow.llm.words import (
    BETWEEN_SPACES,
    UNCHANGED,
    Words,
    as_long,
    gram_hashes,
    mixed,
    pieces,
    powers,
    sliding_min,
    words_of,
)

GRAM = 8
#: distinct segments of an anchor beyond which it is split by whole windows
SPLIT_ANCHOR = 4096
#: bytes of text in which equal segments are merged before they are shipped
MERGED_BYTES = 2 << 20
#: words of a shard
SHARD_WORDS = 1 << 20
#: bytes of a word's hash that are shipped and indexed
SYMBOL = 5

_PLACE = np.uint64((1 << 20) - 1)


class Segments:
    """The runs of windows of a piece that share an anchor occurrence."""

    def __init__(self, words: Words, window: int, gram: int):
        starts = words.starts_with_room(window)
        grams = gram_hashes(words.hashes, gram)
        # the least gram, and of equal ones the first; the place keeps occurrences apart
        keys = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
        least = sliding_min(keys, window - gram + 1)[starts] if len(starts) else keys[:0]
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (np.diff(starts) != 1)
        begins = np.flatnonzero(new)
        self.first = starts[begins]
        self.end = starts[np.append(begins[1:], len(starts)) - 1] + window if len(starts) else starts
        place = (least[begins] - self.first.astype(np.uint64)) & _PLACE
        self.anchor = grams[self.first + place.astype(np.int64)] if len(begins) else grams[:0]
        self.text = words.text_of()[self.first]
        # content: a hash of the segment's words, whatever its place
        many = len(words.hashes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * powers(many))])
        lift = powers(many + 1)[many - self.first]
        self.content = mixed((sums[self.end] - sums[self.first]) * lift + self.anchor)


def _anchor_rows(window: int, gram: int):
    """One row per anchor of a text; anchors that a batch holds twice are sent up once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            parts = []
            for begin, _, data, offsets in pieces(batch.column("text")):
                runs = Segments(words_of(data, offsets, BETWEEN_SPACES, UNCHANGED), window, gram)
                parts.append((runs.anchor, keys[begin + runs.text], runs.content))
            if not parts:
                continue
            anchor, key, content = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((content, anchor))
            anchor, key, content = anchor[order].view(np.int64), key[order], content[order]
            new = np.ones(len(anchor), bool)
            new[1:] = anchor[1:] != anchor[:-1]
            group = np.cumsum(new) - 1
            alone = np.bincount(group)[group] == 1
            varied = new.copy()
            varied[1:] |= content[1:] != content[:-1]
            marks = new & ~alone
            contents = np.bincount(group, varied).astype(np.int64)[group[marks]]
            # known here to repeat: straight to their document
            pairs = np.stack([key[~alone], anchor[~alone]])
            pairs = np.unique(pairs, axis=1) if pairs.size else pairs
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([anchor[alone], anchor[marks], mixed(pairs[0].view(np.uint64)).view(np.int64)])),
                    pa.concat_arrays([as_long(key[alone]), pa.nulls(int(marks.sum()), pa.int64()), as_long(pairs[0])]),
                    pa.concat_arrays([pa.nulls(int(alone.sum() + marks.sum()), pa.int64()), as_long(pairs[1])]),
                    pa.array(np.concatenate([np.ones(alone.sum(), np.int64), contents, np.zeros(pairs.shape[1], np.int64)])),
                ],
                ["route", "key", "anchor", "contents"],
            )

    return rows


def _repeated(split_anchor: int):
    """From rows sorted by route: (key, anchor) of anchors that repeat; anchors to split, with no key."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "route", 1 << 16):
            route = table.column("route").to_numpy()
            contents = table.column("contents").to_numpy()
            known = ~pc.is_null(table.column("anchor")).to_numpy()
            key_column = table.column("key")
            mark = pc.is_null(key_column).to_numpy()
            key = pc.fill_null(key_column, 0).to_numpy()
            open_ = ~known
            ids, group = np.unique(route[open_], return_inverse=True)
            total = np.bincount(group, contents[open_], len(ids))
            own = key[open_]
            marked = np.bincount(group, mark[open_], len(ids)) > 0
            least, most = np.full(len(ids), 2**63 - 1), np.full(len(ids), -(2**63))
            real = ~mark[open_]
            np.minimum.at(least, group[real], own[real])
            np.maximum.at(most, group[real], own[real])
            repeats = marked | (least < most)
            out = repeats[group] & real
            wide = ids[total > split_anchor]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([as_long(own[out]), as_long(key[known]), pa.nulls(len(wide), pa.int64())]),
                    pa.array(
                        np.concatenate(
                            [route[open_][out], pc.fill_null(table.column("anchor"), 0).to_numpy()[known], wide]
                        )
                    ),
                ],
                ["key", "anchor"],
            )

    return rows


def _segment_rows(window: int, gram: int):
    """(shard key, id, key, first word, words) of the segments whose anchor repeats; of equal ones of
    a piece, all but the earliest come as repeats (no shard key; their first and end words)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(name).to_numpy() for name in ("id", "key"))
            lists = batch.column("anchors")
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            flat = pc.list_flatten(lists)
            wanted, wide = flat.field("anchor").to_numpy(), flat.field("wide").to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in pieces(batch.column("text"), MERGED_BYTES):
                words = words_of(data, offsets, BETWEEN_SPACES, UNCHANGED)
                runs = Segments(words, window, gram)
                mine = slice(*np.searchsorted(owner, [begin, end]))
                have = mixed(wanted[mine].view(np.uint64)) ^ (owner[mine] - begin).astype(np.uint64)
                order = np.argsort(have)
                have = have[order]
                asked = mixed(runs.anchor) ^ runs.text.astype(np.uint64)
                at = np.minimum(np.searchsorted(have, asked), max(len(have) - 1, 0))
                hit = have[at] == asked if len(have) else np.zeros(len(asked), bool)
                split = np.zeros(len(asked), bool)
                if len(have):
                    split = hit & wide[mine][order][at]
                first, last = runs.first[hit & ~split], runs.end[hit & ~split]
                shard, content = runs.anchor[hit & ~split], runs.content[hit & ~split]
                if split.any():  # each window on its own
                    counts = runs.end[split] - runs.first[split] - window + 1
                    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    alone = np.repeat(runs.first[split], counts) + step
                    hashes = gram_hashes(words.hashes, window)[alone]
                    first, last = np.append(first, alone), np.append(last, alone + window)
                    shard, content = np.append(shard, hashes), np.append(content, hashes)
                text = words.text_of()[first]
                place = first - words.first[text]
                order = np.lexsort((place, ids[begin + text], content))
                new = np.ones(len(order), bool)
                new[1:] = content[order][1:] != content[order][:-1]
                twin = np.zeros(len(order), bool)  # rows of one id and place are no repeats of each other
                if len(order):
                    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                    p, d = place[order], ids[begin + text][order]
                    twin = (p == p[lead]) & (d == d[lead])
                ship = order[twin]
                again = order[~twin]
                sizes = (last - first)[ship]
                blob_at = np.concatenate([[0], np.cumsum(sizes)])
                take = np.repeat(first[ship] - blob_at[:-1], sizes) + np.arange(blob_at[-1])
                blob = pa.Array.from_buffers(
                    pa.binary(),
                    len(ship),
                    [None, pa.py_buffer((blob_at * SYMBOL).astype(np.int32)), pa.py_buffer(symbols(words.hashes[take]))],
                )
                both = np.concatenate([ship, again])
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(np.concatenate([shard[ship], mixed(text[again].astype(np.uint64))])),
                        as_long(ids[begin + text[both]]),
                        as_long(keys[begin + text[both]]),
                        pa.array(place[both].astype(np.int32)),
                        pa.array((place + last - first)[both].astype(np.int32)),
                        pa.concat_arrays([blob, pa.nulls(len(again), pa.binary())]),
                    ],
                    ["shard", "id", "key", "first", "end", "words"],
                )

    return rows


def symbols(hashes: np.ndarray) -> np.ndarray:
    """The bytes that stand for words in an index."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :SYMBOL])


def repeats_of_shard(ids: np.ndarray, firsts: np.ndarray, words: pa.Array, window: int) -> tuple[np.ndarray, ...]:
    """(segment, first word, end word) of the windows that start earlier elsewhere in the shard."""
    sizes = pc.binary_length(words).to_numpy().astype(np.int64) // SYMBOL
    raw = np.frombuffer(b"".join(words.to_pylist()), np.uint8).reshape(-1, SYMBOL)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :SYMBOL] = raw
    ranks = np.unique(wide.view(np.uint64)[:, 0], return_inverse=True)[1].astype(np.int64) + 1
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(len(ranks) + len(sizes), np.int64)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(ranks)) + segment] = ranks
    index = FmIndex(text, window)
    group = index.stream(begins, sizes)
    at = np.flatnonzero(group >= 0)
    owner = np.searchsorted(begins, at, "right") - 1
    place = firsts[owner] + at - begins[owner]
    order = np.lexsort((place, ids[owner]))
    i, p = ids[owner][order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (i[1:] != i[:-1]) | (p[1:] != p[:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    when = np.full(len(text), 2**62)
    when[at] = rank
    earliest = np.minimum.reduceat(when[index.suffixes], index.group_first[:-1])
    late = rank > earliest[group[at]]
    at, owner, place = at[late], owner[late], place[late]
    joins = np.zeros(len(at), bool)
    joins[1:] = (np.diff(at) == 1) & (owner[1:] == owner[:-1])
    begin = np.flatnonzero(~joins)
    stop = np.append(begin[1:], len(at)) - 1
    return owner[begin], place[begin], place[stop] + window if len(at) else place


def _repeat_rows(window: int, shard_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "shard", SYMBOL * shard_words, lambda t: t.nbytes):
            words = table.column("words")
            held = ~pc.is_null(words).to_numpy()
            ids, keys, firsts, ends = (table.column(n).to_numpy() for n in ("id", "key", "first", "end"))
            shipped = words.filter(pa.array(held)).combine_chunks()
            owner, low, high = np.zeros(0, np.int64), firsts[:0], firsts[:0]
            if held.any():
                owner, low, high = repeats_of_shard(ids[held], firsts[held].astype(np.int64), shipped, window)
            yield pa.RecordBatch.from_arrays(
                [
                    as_long(np.concatenate([ids[held][owner], ids[~held]])),
                    as_long(np.concatenate([keys[held][owner], keys[~held]])),
                    pa.array(np.concatenate([low, firsts[~held]]).astype(np.int32)),
                    pa.array(np.concatenate([high, ends[~held]]).astype(np.int32)),
                ],
                ["id", "key", "first", "end"],
            )

    return rows


def _kept_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = pc.fill_null(batch.column("is_copy"), False).to_numpy(zero_copy_only=False)
            lists = batch.column("spans")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            flat = pc.list_flatten(lists)
            low, high = flat.field("first").to_numpy(), flat.field("end").to_numpy()
            at = np.concatenate([[0], np.cumsum(sizes)])
            for begin, end, data, offsets in pieces(batch.column("text")):
                raw, totals, dropped, kept = data.tobytes(), [], [], []
                for row in range(begin, end):
                    words = raw[offsets[row - begin] : offsets[row - begin + 1]].split()
                    gone = 0
                    if copies[row] and len(words) >= window:
                        gone, totals_here, words = len(words), len(words), []
                    else:
                        totals_here = len(words)
                        if sizes[row]:
                            edge = np.zeros(len(words) + 1, np.int64)
                            np.add.at(edge, low[at[row] : at[row + 1]], 1)
                            np.subtract.at(edge, high[at[row] : at[row + 1]], 1)
                            stay = np.cumsum(edge)[:-1] == 0
                            gone = len(words) - int(stay.sum())
                            words = list(compress(words, stay))
                    totals.append(totals_here)
                    dropped.append(gone)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        pa.array(totals, pa.int64()),
                        pa.array(dropped, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return rows


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    gram: int = GRAM,
    split_anchor: int = SPLIT_ANCHOR,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (bytes of UTF-8) of every row of ``docs``."""
    if not 1 <= gram < window:
        raise ValueError("the anchor's grams must be shorter than the window")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        order_id().alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("key"),
    )
    # stored: a join with it may then split the key of a text that very many documents have
    firsts = stored(texts.groupBy("key").agg(F.min("id").alias("id")))
    anchors = texts.select("text", "key").mapInArrow(
        _anchor_rows(window, gram), "route long, key long, anchor long, contents long"
    )
    by_anchor = anchors.repartition("route").sortWithinPartitions("route")
    repeated = stored(by_anchor.mapInArrow(_repeated(split_anchor), "key long, anchor long"))
    wide = repeated.where("key is null").select("anchor", F.lit(True).alias("wide"))
    lists = (
        repeated.where("key is not null")
        .join(wide, "anchor", "left")
        .groupBy("key")
        .agg(F.collect_list(F.struct("anchor", F.coalesce("wide", F.lit(False)).alias("wide"))).alias("anchors"))
        .join(firsts, "key")
    )
    # sorted, so that a task that is run again merges the same segments
    wanted = texts.join(lists.hint("shuffle_hash"), ["id", "key"]).sortWithinPartitions("id", "key")
    segments = wanted.select("id", "key", "text", "anchors").mapInArrow(
        _segment_rows(window, gram), "shard long, id long, key long, first int, end int, words binary"
    )
    repeats = segments.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _repeat_rows(window, shard_words), "id long, key long, first int, end int"
    )
    spans = repeats.groupBy("id", "key").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    # a later document with the text of an earlier one: all its windows start earlier there
    copies = (
        texts.select("id", "key")
        .distinct()
        .join(firsts.withColumnRenamed("id", "least"), "key")
        .where("id > least")
        .select("id", "key", F.lit(True).alias("is_copy"))
    )
    marks = spans.join(copies, ["id", "key"], "full_outer")
    return (
        texts.join(marks.hint("shuffle_hash"), ["id", "key"], "left")
        .select("doc_id", "text", "is_copy", "spans")
        .mapInArrow(_kept_rows(window), "doc_id long, n_words long, n_removed long, kept_text binary")
    )


def op1_substring_dedup(spark, sf_dir):
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
