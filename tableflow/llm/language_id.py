"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and its code point. A run of three
letters is bound into one vector: the product of its letters' vectors, each rotated by its place. A
text is the bundle (sum) of the vectors of its runs; a language's prototype is the bundle of all its
training texts. A text gets the language whose prototype makes the least angle with it.

Sums are of whole numbers, so neither order nor partitioning changes a prototype. Each task sends one
prototype per language; the driver gets as many vectors as there are languages.

Texts are lower-cased; what is no letter counts as one blank, and a text begins and ends with one.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing can be learned from. Of languages that fit alike, the first in order wins. Every row is
judged, repeated ones alike, and learned from as often as it occurs. A very long text is one array of its task, some
100 bytes a character. More than ``MOST_LANGUAGES`` languages are refused: the column holds something else. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.words import mixed, pieces

DIMENSIONS = 1024
SEED = 1
#: languages whose profiles (8 KB each) are kept and sent to tasks
MOST_LANGUAGES = 4096
UNKNOWN = "und"
#: documents of this remainder of crc32(id) modulo 4 are held out
HELD_OUT = 2
PIECE = 1 << 20
#: numbers of a dense block of counts
BLOCK = 1 << 22


class Alphabet:
    """Code point -> lower-cased letter, 0 for all else; filled as code points are met."""

    def __init__(self):
        self.letter = np.zeros(0x110000, np.uint32)
        self.seen = np.zeros(0x110000, bool)

    def letters(self, points: np.ndarray) -> np.ndarray:
        if not self.seen[points].all():
            for point in np.unique(points[~self.seen[points]]).tolist():
                self.seen[point] = True
                if chr(point).isalpha():
                    self.letter[point] = ord(chr(point).lower()[0])
        return self.letter[points]


def letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """A row of +1 and -1 per letter (0: the blank)."""
    lanes = np.arange(-(-dimensions // 64), dtype=np.uint64)
    seeds = letters.astype(np.uint64)[:, None] * np.uint64(1 << 20) + lanes[None, :] + np.uint64(SEED << 48)
    bits = np.unpackbits(mixed(mixed(seeds)).view(np.uint8), axis=1, bitorder="little")[:, :dimensions]
    return bits.astype(np.float32) * 2 - 1


class Runs:
    """The distinct runs of three letters of each text of a list, with counts and vectors."""

    def __init__(self, texts: list[str], alphabet: Alphabet):
        joined = "".join(f"\n{text}\n" for text in texts).encode("utf-32-le", "replace")
        letters = alphabet.letters(np.frombuffer(joined, np.uint32))
        owner = np.repeat(np.arange(len(texts)), [len(text) + 2 for text in texts])
        begins = np.ones(len(owner), bool)
        begins[1:] = owner[1:] != owner[:-1]
        keep = (letters != 0) | begins
        keep[1:] |= letters[:-1] != 0
        self.has_letter = np.bincount(owner[letters != 0], minlength=len(texts)) > 0
        letters, owner = letters[keep], owner[keep]
        self.letters, small = np.unique(letters, return_inverse=True)
        size = len(self.letters)
        small = small.astype(np.int64)
        inside = owner[2:] == owner[:-2] if len(owner) > 2 else np.zeros(0, bool)
        code = ((small[:-2] * size + small[1:-1]) * size + small[2:])[inside] if len(owner) > 2 else small[:0]
        keys = np.sort(owner[:-2][inside] * size**3 + code) if len(code) else code
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        self.counts = np.diff(np.append(first, len(keys))).astype(np.float32)
        self.text, run = np.divmod(keys[first], size**3)
        self.codes, self.run = np.unique(run, return_inverse=True)
        self.size = size

    def vectors(self, dimensions: int) -> np.ndarray:
        own = letter_vectors(self.letters, dimensions)
        first, rest = np.divmod(self.codes, self.size**2)
        second, third = np.divmod(rest, self.size)
        return np.roll(own, 2, 1)[first] * np.roll(own, 1, 1)[second] * own[third]

    def bundles(self, rows: np.ndarray, count: int, dimensions: int) -> np.ndarray:
        """Sum of the run vectors by row; ``rows`` has the row of each text, -1 for none."""
        vectors = self.vectors(dimensions)
        out = np.zeros((count, dimensions), np.float64)
        step = max(1, BLOCK // max(1, len(self.codes)))
        target = rows[self.text]
        for low in range(0, count, step):
            high = min(count, low + step)
            mine = (target >= low) & (target < high)
            dense = np.zeros((high - low) * len(self.codes), np.float32)
            np.add.at(dense, (target[mine] - low) * len(self.codes) + self.run[mine], self.counts[mine])
            out[low:high] = dense.reshape(high - low, -1) @ vectors
        return out


def _profile_rows(dimensions: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, sums = Alphabet(), {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for begin, end, _, _ in pieces(batch.column("text"), PIECE):
                texts = batch.column("text").slice(begin, end - begin).to_pylist()
                names, row = np.unique(langs[begin:end].astype(str), return_inverse=True)
                parts = Runs(texts, alphabet).bundles(row, len(names), dimensions)
                for name, part in zip(names.tolist(), parts, strict=True):
                    sums[name] = sums.get(name, 0) + part.astype(np.int64)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)],
                ["lang", "dimension", "value"],
            )

    return rows


def prototypes(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the unit vector of each; from rows with text and lang."""
    known = docs.select("text", "lang").where("text is not null and lang is not null")
    names = [row["lang"] for row in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: profiles are kept for that many")
    names.sort()
    sums = known.mapInArrow(_profile_rows(dimensions), "lang string, dimension int, value long")
    rows = sums.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toArrow()
    place = {name: at for at, name in enumerate(names)}
    table = np.zeros((len(names), dimensions))
    at = np.array([place[name] for name in rows.column("lang").to_pylist()], np.int64)
    table[at, rows.column("dimension").to_numpy()] = rows.column("value").to_numpy()
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    return names, table / np.where(lengths > 0, lengths, 1)


def _guess_rows(names: list[str], table: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            column = batch.column("text").fill_null("")
            for begin, end, _, _ in pieces(column, PIECE):
                count = end - begin
                runs = Runs(column.slice(begin, count).to_pylist(), alphabet)
                guess, score = [UNKNOWN] * count, np.zeros(count)
                if names:
                    own = runs.bundles(np.arange(count), count, table.shape[1])
                    lengths = np.linalg.norm(own, axis=1)
                    cosine = np.round(own @ table.T / np.where(lengths > 0, lengths, 1)[:, None], 9)
                    best = cosine.argmax(1)
                    guess = [names[b] if has else UNKNOWN for b, has in zip(best, runs.has_letter, strict=True)]
                    score = np.where(runs.has_letter, np.clip(cosine[np.arange(count), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, count), pa.array(guess, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    return rows


def identify_languages(docs: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, 0 to 1) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_guess_rows(names, table), "doc_id long, lang_pred string, score double")


def op7_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    names, table = prototypes(docs.where(fold != HELD_OUT))
    guessed = identify_languages(docs, names, table)
    held_out = F.coalesce(fold == HELD_OUT, F.lit(False))
    return guessed.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
