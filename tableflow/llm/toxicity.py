"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled documents (those with the least hash of the id, one of each text) is the
set of examples. A document's vector holds the TF-IDF weights of all its words that some example has, and
beside them, as one more feature with a share ``MARKED`` of its square length, those of its marks: words and word beginnings
that mark toxic examples (chi-squared test of presence, and mostly in toxic ones; beginnings, since words
inflect). A term's rarity is counted over every document of the corpus.

The index has the postings of each term; those of common terms are kept as dense rows by blocks of
examples, with each term's greatest weight in the block. The postings of rarer terms are summed first; a
text then skips the common terms of every block whose greatest possible cosine does not beat a bound of its
k-th best, so the neighbours are exact. They vote with their cosines; the vote is mapped to a probability
by isotonic regression on the examples, each voted on by the others (a Spark job over the stored examples; the driver
gets one vote of each). A text without any word of an example gets the rate of such examples. The
nearest examples are returned as evidence. An example that is scored finds itself among them, as a labelled document should.

Bounds: the index holds at most ``EXAMPLES`` texts of ``EXAMPLE_BYTES`` in all, each once however many rows have it; a text that
does not fit is left out. Tasks get it as arrays, once per worker.

Defined cases: a null or empty text has no word, no evidence; every row is scored, repeated ones alike; a document
labelled twice counts once, as toxic if any label says so; rows that share a labelled id but not the text are examples of
that label each; equal texts of several labelled documents count once, with the label of the least id; of examples
that are equally near, the earlier in the index counts. Without examples every score is 0. A very long
text is scored whole, in one task, which holds some 50 bytes for each of its words. Extra columns can be carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.shared import ready, stored
from tableflow.llm.words import LETTERS_AND_DIGITS, LOWER, as_long, pieces, words_of

#: labelled documents of the sample, and bytes of their texts
EXAMPLES = 12_000
EXAMPLE_BYTES = 64 << 20
#: marks at most; the chi-squared value (p < 0.0001), examples and share of toxic ones they need
MARKS = 512
LEAST_CHI2 = 15.1
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.8
NEIGHBOURS = 25
BLOCK = 64
#: share of a vector's square length that its marks have
MARKED = 0.8
#: share of the examples that have a common term
COMMON = 0.07
#: queries that are looked up together
QUERIES = 40
#: code points of the word beginnings that may be marks
BEGINNINGS = (4,)
EVIDENCE = 3
#: documents of this remainder of crc32(id) modulo 5 are held out
HELD_OUT = 0


def candidates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, hash) of every word, then of every word beginning of a piece, and how many words there are."""
    words = words_of(data, offsets, LETTERS_AND_DIGITS, LOWER, with_sums=True)
    text = words.text_of()
    texts, hashes = [text], [words.hashes]
    for points in BEGINNINGS:
        longer, own = words.prefixes(points)
        texts.append(text[longer])
        hashes.append(own)
    return np.concatenate(texts), np.concatenate(hashes), len(text)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic) of the distinct words and beginnings of each text."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for begin, _, data, offsets in pieces(batch.column("text")):
            text, hashes, _ = candidates(data, offsets)
            order = np.lexsort((hashes, text))
            text, hashes = text[order], hashes[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
            yield pa.RecordBatch.from_arrays(
                [as_long(hashes[new]), pa.array(toxic[begin + text[new]], pa.int32())], ["word", "toxic"]
            )


def choose_marks(examples: DataFrame) -> np.ndarray:
    """Hashes, in order, of the words and beginnings that mark toxic examples most."""
    totals = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    n, p = totals["n"], totals["p"]
    if not p or p == n:
        return np.zeros(0, np.uint64)
    words = examples.select("text", "toxic").mapInArrow(_word_rows, "word long, toxic int").groupBy("word")
    seen = words.agg(F.count("*").alias("a"), F.sum("toxic").alias("t"))
    seen = seen.where((F.col("a") >= LEAST_DOCUMENTS) & (F.col("t") >= F.lit(LEAST_SHARE) * F.col("a")))
    gap = F.col("t") * F.lit(float(n)) - F.col("a") * F.lit(float(p))
    chi2 = gap * gap * F.lit(float(n)) / (F.col("a") * (F.lit(float(n)) - F.col("a")) * F.lit(float(p) * (n - p)))
    scored = seen.where(F.col("a") < n).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
    rows = scored.orderBy(F.desc("chi2"), "word").limit(MARKS).select("word").collect()
    return np.sort(np.array([row["word"] for row in rows], np.int64).view(np.uint64))


@dataclass
class Entries:
    """A sparse matrix: value of each (row, term) that is not 0, by row."""

    count: int
    width: int
    row: np.ndarray
    term: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, dense: np.ndarray) -> Entries:
        row, term = np.nonzero(dense)
        return cls(*dense.shape, row.astype(np.int32), term.astype(np.int32), dense[row, term])

    @classmethod
    def joined(cls, count: int, width: int, *parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Entries:
        """The matrix of (row, term, value) parts."""
        row, term, value = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.argsort(row, kind="stable")
        return cls(count, width, row[order].astype(np.int32), term[order].astype(np.int32), value[order].astype(np.float64))

    def taken(self, rows: np.ndarray) -> Entries:
        """The rows of these numbers, in their order."""
        first = np.searchsorted(self.row, np.arange(self.count + 1))
        at, size = _ranges(first[rows], first[rows + 1])
        return Entries(len(rows), self.width, np.repeat(np.arange(len(rows), dtype=np.int32), size), self.term[at], self.value[at])


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the ranges, one after the other; size of each range)."""
    size = high - low
    begin = np.cumsum(size) - size
    every = np.arange(size.sum())
    every += np.repeat(low - begin, size)
    return every, size


def _cells(count: int, text: np.ndarray, hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place in ``known``, how often) of the known hashes of each text."""
    if not len(known) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    order = np.argsort(hashes)  # the search is much faster in order
    text, hashes = text[order], hashes[order]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    cell, often = np.unique(text[hit] * len(known) + at[hit], return_counts=True)
    return cell // len(known), cell % len(known), often


def term_counts(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, marks: np.ndarray) -> Entries:
    """How often each text has each term; terms are the words, then the marks."""
    count = len(offsets) - 1
    text, hashes, plain = candidates(data, offsets)
    row, word, often = _cells(count, text[:plain], hashes[:plain], words)
    marked, mark, times = _cells(count, text, hashes, marks)
    return Entries.joined(
        count, len(words) + len(marks), (row, word, often), (marked, mark + len(words), times)
    )


def _document_rows(words: np.ndarray, marks: np.ndarray):
    """(term, documents that have it); term -1: all documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, having = 0, np.zeros(len(words) + len(marks), np.int64)
        for batch in batches:
            total += len(batch)
            for _, _, data, offsets in pieces(batch.column("text")):
                having += np.bincount(term_counts(data, offsets, words, marks).term, minlength=len(having))
        seen = np.flatnonzero(having)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1).astype(np.int32)), pa.array(np.append(having[seen], total))],
            ["term", "documents"],
        )

    return rows


def rarity(docs: DataFrame, words: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each term over all documents."""
    counts = docs.select("text").mapInArrow(_document_rows(words, marks), "term int, documents long")
    found = counts.groupBy("term").agg(F.sum("documents").alias("n")).toArrow()
    term, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    total, having = n[term == -1].sum(), np.zeros(len(words) + len(marks))
    having[term[term >= 0]] = n[term >= 0]
    return np.log((1 + total) / (1 + having)) + 1


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    lengths = np.sqrt((weights**2).sum(1, keepdims=True))
    return weights / np.where(lengths > 0, lengths, 1)


def unit_entries(counts: Entries, idf: np.ndarray, words: int) -> Entries:
    """``unit_rows`` of the words and of the marks, put together to unit rows."""
    weight = (1 + np.log(counts.value)) * idf[counts.term]
    marked = counts.term >= words
    for kind, share in ((~marked, 1 - MARKED), (marked, MARKED)):
        squares = np.bincount(counts.row[kind], weight[kind] ** 2, minlength=counts.count)
        weight[kind] *= np.sqrt(share / squares[counts.row[kind]])
    squares = np.bincount(counts.row, weight**2, minlength=counts.count)
    weight /= np.sqrt(squares[counts.row])
    return Entries(counts.count, counts.width, counts.row, counts.term, weight)


class BlockMaxIndex:
    """Postings of unit vectors; those of common terms by blocks, with the greatest weight in each block."""

    def __init__(self, vectors: np.ndarray | Entries):
        vectors = vectors if isinstance(vectors, Entries) else Entries.of(vectors)
        self.count, self.width = vectors.count, vectors.width
        self.blocks = -(-self.count // BLOCK)
        having = np.bincount(vectors.term, minlength=self.width)
        self.common = np.flatnonzero(having > max(COMMON * self.count, 1))
        self.place = np.full(self.width, -1, np.int32)
        self.place[self.common] = np.arange(len(self.common))
        often = self.place[vectors.term] >= 0
        kind = np.uint16 if self.count < 1 << 16 else np.int32
        self.often = (vectors.row[often].astype(kind), self.place[vectors.term[often]].astype(kind), vectors.value[often])
        rare = np.flatnonzero(~often).astype(np.int32)
        rare = rare[np.argsort(vectors.term[rare], kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.where(self.place < 0, having, 0))])
        self.examples, self.weights = vectors.row[rare].astype(kind), vectors.value[rare]

    def parts(self) -> dict:
        """What the index is made of: numbers and arrays."""
        return {name: value for name, value in self.__dict__.items() if name not in ("dense", "most")}

    @classmethod
    def of(cls, parts: dict) -> BlockMaxIndex:
        index = object.__new__(cls)
        index.__dict__.update(parts)
        return index

    @cached_property
    def dense(self) -> np.ndarray:
        """Weights of the common terms in each example; the last block is filled up. Not sent to tasks."""
        dense = np.zeros((self.blocks * BLOCK, len(self.common)), self.weights.dtype)
        dense[self.often[0], self.often[1]] = self.often[2]
        return dense

    @cached_property
    def most(self) -> np.ndarray:
        return self.dense.reshape(self.blocks, BLOCK, len(self.common)).max(1)

    def nearest(
        self, queries: np.ndarray | Entries, k: int, without: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest by query, nearest first, earlier examples first on ties.

        ``without`` names an example that each query must not find. Missing neighbours are -1.
        """
        queries = queries if isinstance(queries, Entries) else Entries.of(queries)
        found = np.full((queries.count, k), -1, np.int64)
        cosines = np.zeros((queries.count, k))
        if not self.count:
            return found, cosines
        edges = np.searchsorted(queries.row, np.arange(queries.count + 1))
        for low in range(0, queries.count, QUERIES):
            high = min(low + QUERIES, queries.count)
            own = slice(edges[low], edges[high])
            excluded = None if without is None else without[low:high]
            rows = (queries.row[own] - low, queries.term[own], queries.value[own])
            row, who, cosine = self._best(high - low, *rows, k, excluded)
            order = np.lexsort((who, -cosine, row))
            row, who, cosine = row[order], who[order], cosine[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best = (rank < k) & (cosine > 0)
            found[low + row[best], rank[best]] = who[best]
            cosines[low + row[best], rank[best]] = cosine[best]
        return found, cosines

    def _best(self, count, row, term, value, k, without) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, example, cosine) of examples among which are the k nearest of each query."""
        size = self.blocks * BLOCK
        often = self.place[term] >= 0
        rare = np.flatnonzero(~often)
        at, sizes = _ranges(self.first[term[rare]], self.first[term[rare] + 1])
        cell = np.repeat(row[rare].astype(np.int64) * size, sizes)
        cell += self.examples[at]
        weight = self.weights[at]
        weight *= np.repeat(value[rare], sizes)
        sums = np.bincount(cell, weight, minlength=count * size)
        sums = sums.astype(np.float64, copy=False).reshape(count, size)  # whole numbers if there is none
        if without is not None:
            sums[without >= 0, without[without >= 0]] = -np.inf
        dense = np.zeros((count, len(self.common)))
        dense[row[often], self.place[term[often]]] = value[often]
        # a hair below, for rounding
        least = self._least(sums, k) - 1e-9
        highest = sums.reshape(count, self.blocks, BLOCK).max(2) + dense @ self.most.T
        for block in range(self.blocks):
            open_ = np.flatnonzero(highest[:, block] > least)
            part = slice(block * BLOCK, (block + 1) * BLOCK)
            if len(open_):
                sums[open_, part] += dense[open_] @ self.dense[part].T
        least = np.maximum(self._least(sums, k) - 1e-9, 1e-12)
        query, example = np.nonzero(sums >= least[:, None])
        return query, example, np.round(sums[query, example], 12)

    def _least(self, sums: np.ndarray, k: int) -> np.ndarray:
        """What at least k examples of each query reach: the k-th of the greatest of each few examples."""
        few = max(1, min(BLOCK, sums.shape[1] // (4 * k)))
        few = 1 << (few.bit_length() - 1)
        tops = sums.reshape(len(sums), -1, few).max(2)
        if tops.shape[1] <= k:
            return np.zeros(len(sums))
        return np.maximum(np.partition(tops, -k, axis=1)[:, -k], 0)


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (least vote, probability) of the non-decreasing fit of labels to votes."""
    order = np.argsort(votes, kind="stable")
    blocks: list[list[float]] = []
    for vote, label in zip(votes[order].tolist(), labels[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == vote:
            blocks[-1][1] += label
            blocks[-1][2] += 1
        else:
            blocks.append([vote, label, 1, vote])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, total, count, most = blocks.pop()
            blocks[-1][1] += total
            blocks[-1][2] += count
            blocks[-1][3] = most
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


@dataclass
class Model:
    words: np.ndarray
    marks: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    index: BlockMaxIndex
    empty_rate: float
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0), np.zeros(0)))

    def votes(self, queries: Entries, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, cosines = self.index.nearest(queries, NEIGHBOURS, without)
        weight = cosines.sum(1)
        vote = (cosines * np.where(found >= 0, self.labels[found], 0)).sum(1) / np.where(weight > 0, weight, 1)
        return np.round(vote, 9), found, cosines

    def scores(self, counts: Entries) -> tuple[np.ndarray, pa.Array]:
        """Score of each text, and its nearest examples."""
        score = np.full(counts.count, self.empty_rate)
        who, how = np.zeros(0, np.int64), np.zeros(0)
        edges = np.zeros(counts.count + 1, np.int64)
        filled = np.unique(counts.row)
        if len(filled) and self.index.count:
            queries = unit_entries(counts, self.idf, len(self.words)).taken(filled)
            vote, found, cosines = self.votes(queries)
            near = found[:, 0] >= 0
            least, rate = self.steps
            at = np.maximum(np.searchsorted(least, vote, "right") - 1, 0)
            score[filled[near]] = rate[at[near]]
            listed = found[:, :EVIDENCE] >= 0
            who, how = found[:, :EVIDENCE][listed], cosines[:, :EVIDENCE][listed]
            edges[filled + 1] = listed.sum(1)
        examples = pa.StructArray.from_arrays(
            [pa.array(self.ids[who], pa.int64()), pa.array(how), pa.array(self.labels[who], pa.int32())],
            ["doc_id", "cosine", "toxic"],
        )
        return score, pa.ListArray.from_arrays(pa.array(np.cumsum(edges), pa.int32()), examples)

    def parts(self) -> dict:
        """What the model is made of, without a class that executors would have to know."""
        return self.__dict__ | {"index": self.index.parts()}

    @classmethod
    def of(cls, parts: dict) -> Model:
        return cls(**parts | {"index": BlockMaxIndex.of(parts["index"])})


def _plain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column("text")):
            yield pa.RecordBatch.from_arrays([as_long(np.unique(words_of(data, offsets, LETTERS_AND_DIGITS, LOWER).hashes))], ["word"])


def _example_rows(words: np.ndarray, marks: np.ndarray, idf: np.ndarray):
    """(number, terms, weights) of each example's unit vector, packed."""

    def packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
        return pa.array([values[low:high].tobytes() for low, high in zip(edges[:-1], edges[1:], strict=True)], pa.binary())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column("text")):
                vectors = unit_entries(term_counts(data, offsets, words, marks), idf, len(words))
                edges = np.searchsorted(vectors.row, np.arange(end - begin + 1))
                columns = [packed(vectors.term, edges), packed(vectors.value.astype(np.float32), edges)]
                number = batch.column("number").slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([number, *columns], ["number", "terms", "weights"])

    return rows


def _vectors(rows: pa.Table, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of terms of each example, terms, weights) from packed rows in any order."""
    numbers = rows.column("number").to_numpy()
    sizes = np.zeros(count, np.int64)
    sizes[numbers] = pc.binary_length(rows.column("terms")).to_numpy() // 4
    ends = np.cumsum(sizes)
    term, weight = np.empty(int(sizes.sum()), np.int32), np.empty(int(sizes.sum()), np.float32)
    for name, values in (("terms", term), ("weights", weight)):
        for number, value in zip(numbers.tolist(), rows.column(name)):
            values[ends[number] - sizes[number] : ends[number]] = np.frombuffer(value.as_buffer(), values.dtype)
    return sizes, term, weight


def choose_examples(docs: DataFrame, labels: DataFrame, examples: int, most_bytes: int) -> tuple[DataFrame, pa.Table]:
    """(number, doc_id, toxic, text) of the examples, stored; and their names, in order of their numbers."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    marks = marks.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    text = F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sized = named.select("doc_id", "text_hash", F.octet_length("text").alias("bytes"))
    copies = sized.join(F.broadcast(marks.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
    firsts = copies.groupBy("text_hash").agg(F.min(F.struct("doc_id", "toxic", "bytes")).alias("first"))
    firsts = firsts.select("text_hash", "first.*").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash").limit(examples)
    names = firsts.select("doc_id", "text_hash", "toxic", "bytes").toArrow()
    kept, held = [], 0
    for size in names.column("bytes").to_pylist():
        kept.append(held + size <= most_bytes)
        held += size * kept[-1]
    names = names.filter(pa.array(kept, pa.bool_())).drop_columns(["bytes"])
    names = names.append_column("number", pa.array(np.arange(len(names)), pa.int32()))
    spark = docs.sparkSession
    listed = spark.createDataFrame(names) if len(names) else spark.createDataFrame(
        [], "doc_id long, text_hash long, toxic int, number int"
    )
    rows = named.join(F.broadcast(listed), ["doc_id", "text_hash"])
    chosen = rows.groupBy("number").agg(*[F.first(name).alias(name) for name in ("doc_id", "toxic", "text")])
    return stored(chosen), names


def _vote_rows(parts: Broadcast, places: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vote of the other examples on each example that has a word."""
        model = Model.of(parts.value)
        for batch in batches:
            number = batch.column("number").to_numpy()
            for begin, end, data, offsets in pieces(batch.column("text")):
                counts = term_counts(data, offsets, model.words, model.marks)
                filled = np.unique(counts.row)
                queries = unit_entries(counts, model.idf, len(model.words)).taken(filled)
                own = places[number[begin:end][filled]]
                vote, _, _ = model.votes(queries, own)
                yield pa.RecordBatch.from_arrays([pa.array(vote), pa.array(model.labels[own], pa.int64())], ["vote", "toxic"])

    return rows


def fit(
    docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, most_bytes: int = EXAMPLE_BYTES
) -> Model:
    """The model from ``docs`` and at most ``examples`` rows of ``labels`` (doc_id, toxic)."""
    chosen, names = choose_examples(docs, labels, examples, most_bytes)
    marks = choose_marks(chosen)
    words = chosen.select("text").mapInArrow(_plain_words, "word long").distinct().toArrow()
    words = np.sort(words.column("word").to_numpy().view(np.uint64))
    width = len(words) + len(marks)
    idf = rarity(docs, words, marks)
    rows = chosen.select("number", "text").mapInArrow(
        _example_rows(words, marks, idf), "number int, terms binary, weights binary"
    ).toArrow()
    sizes, term, weight = _vectors(rows, len(names))
    del rows
    pa.default_memory_pool().release_unused()
    toxic = names.column("toxic").to_numpy().astype(np.int64)
    ids = names.column("doc_id").to_numpy().astype(np.int64)
    filled = np.flatnonzero(sizes)
    bare = np.delete(toxic, filled)
    empty_rate = float(bare.mean()) if len(bare) else (float(toxic.mean()) if len(toxic) else 0.0)
    # neighbours in the order of their heaviest common term, so that blocks share terms
    heavy = np.bincount(term, minlength=width).astype(np.float32)[term]
    heavy *= weight
    ends = np.cumsum(sizes)
    heaviest = [int(term[end - size : end][heavy[end - size : end].argmax()]) for end, size in zip(ends[filled], sizes[filled])]
    del heavy
    order = filled[np.argsort(np.array(heaviest, np.int64), kind="stable")]
    places = np.full(len(ids), -1, np.int32)
    places[order] = np.arange(len(order))
    vectors = Entries(len(order), width, np.repeat(places, sizes), term, weight)
    del term, weight
    model = Model(words, marks, idf, ids[order], toxic[order], BlockMaxIndex(vectors), empty_rate)
    del vectors
    if model.index.count:
        parts = ready(docs.sparkSession).sparkContext.broadcast(model.parts())
        votes = chosen.select("number", "text").mapInArrow(_vote_rows(parts, places), "vote double, toxic long").toArrow()
        parts.destroy()
        votes = votes.take(pc.sort_indices(votes, [("vote", "ascending"), ("toxic", "ascending")]))
        model.steps = isotonic(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy())
    return model


def _score_rows(parts: Broadcast, text_in_row: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(parts.value)
        for batch in batches:
            text = pc.struct_field(batch.column("row"), "text") if text_in_row else batch.column("text")
            for begin, end, data, offsets in pieces(text):
                score, evidence = model.scores(term_counts(data, offsets, model.words, model.marks))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(begin, end - begin),
                        pa.array(score, pa.float64()),
                        pa.array((score >= 0.5).astype(np.int32)),
                        evidence.cast(_EVIDENCE),
                    ],
                    ["row", "score", "predicted", "evidence"],
                )

    return rows


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def score_toxicity(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """row (the carried columns, all by default), score, predicted, evidence of every document."""
    carry = docs.columns if carry is None else carry
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in carry]).alias("row"), "text")
    row = packed.schema["row"].dataType.simpleString()
    evidence = "array<struct<doc_id: bigint, cosine: double, toxic: int>>"
    text_in_row = "text" in carry  # then the texts are sent once
    parts = ready(docs.sparkSession).sparkContext.broadcast(model.parts())  # lives as long as the result
    scored = _score_rows(parts, text_in_row)
    if text_in_row:
        packed = packed.select("row")
    return packed.mapInArrow(scored, f"row {row}, score double, predicted int, evidence {evidence}")


def fold_of(name: str = "doc_id"):
    return F.crc32(F.col(name).cast("string")) % 5


def op6_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = fit(docs, labels.where(fold_of() != HELD_OUT))
    scored = score_toxicity(docs, model, ["doc_id"]).select("row.doc_id", "score", "predicted", "evidence")
    held_out = F.coalesce(fold_of() == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")
