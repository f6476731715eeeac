"""Line dedup: lines found in many documents go from every document.

Distinct line hashes are dealt to shards; each shard builds a minimal perfect hash over its lines and
keeps, by the slot it gives, a compact fingerprint and the number of documents. Documents are dealt
to chunks of a few MB; a chunk probes the arrays of a shard with each of its distinct lines once, and
gets back those that are common. No line of a document meets another by a join, and a line that a
third of all documents hold is one row per chunk, added up before it is shuffled.

Defined cases: a null or empty text has one empty line (a null stays null); every row is a document of its own, also
when rows repeat. Lines whose 64-bit hashes agree are taken to be alike. An index may be probed with
lines it does not hold: they pass for absent but for a chance of 2^-32 per probe. A very long text is split in one
task, whole. Extra columns can be carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.words import ASCII_LOWER, mixed, pieces

#: bytes of text of a chunk of documents; a shard holds the lines of a few chunks
CHUNK_BYTES = 4 << 20
CHUNKS_PER_SHARD = 4
#: slots per key of each level of the perfect hash
LOAD = 2

SPACES = b" \t\n\v\f\r"

INDEX = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary"


@dataclass
class PerfectHash:
    """Slots 0 to n - 1 for n distinct 64-bit keys: levels of bits, one bit per key in all.

    A level hashes the keys left over to twice as many places; a key alone at its place stays there,
    the others go down a level. A key's slot is the number of bits set before its own.
    """

    sizes: np.ndarray
    bits: np.ndarray

    def __post_init__(self):
        blocks = self.bits.view(np.uint64)
        self.blocks = blocks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks).astype(np.int64))])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys + np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, rows = [], []
        while len(keys):
            size = -(-LOAD * len(keys) // 64) * 64
            at = cls.place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            rows.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(rows) if rows else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has a bit for it."""
        slots = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + self.place(keys[left], level, int(size))
            block, bit = at >> 6, (at & 63).astype(np.uint64)
            is_set = (self.blocks[block] >> bit) & np.uint64(1) == 1
            low = (np.uint64(1) << bit[is_set]) - np.uint64(1)
            inside = np.bitwise_count(self.blocks[block[is_set]] & low).astype(np.int64)
            slots[left[is_set]] = self.before[block[is_set]] + inside
            left = left[~is_set]
        return slots


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(~keys) >> np.uint64(32)).astype(np.uint32)


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).translate(ASCII_LOWER)


def line_hash(key: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, line, documents) of the lines that are not empty, added up over a batch."""
    for batch in batches:
        chunks = batch.column("chunk").to_pylist()
        found: dict[tuple[int, int], int] = {}
        for begin, end, data, offsets in pieces(batch.column("text")):
            raw = data.tobytes()
            for row in range(begin, end):
                text = raw[offsets[row - begin] : offsets[row - begin + 1]]
                keys = {line_key(line) for line in text.split(b"\n")}
                keys.discard(b"")
                for key in keys:
                    at = (chunks[row], line_hash(key))
                    found[at] = found.get(at, 0) + 1
        pairs = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk for chunk, _ in pairs], pa.int64()),
                pa.array([line for _, line in pairs], pa.int64()),
                pa.array(found.values(), pa.int64()),
            ],
            ["chunk", "line", "documents"],
        )


def _build(table: pa.Table) -> pa.Table:
    lines, own = np.unique(table.column("line").to_numpy(), return_inverse=True)
    keys = lines.view(np.uint64)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, own, table.column("documents").to_numpy())
    index = PerfectHash.of(keys)
    slots = index.slots(keys)
    prints, counts = np.empty(len(keys), np.uint32), np.empty(len(keys), np.uint32)
    prints[slots] = fingerprints(keys)
    counts[slots] = np.minimum(total, 2**32 - 1)
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
            "sizes": pa.array([index.sizes.tolist()], pa.list_(pa.int64())),
            "bits": pa.array([index.bits.tobytes()], pa.binary()),
            "fingerprints": pa.array([prints.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
        }
    )


def probe(index: dict, keys: np.ndarray) -> np.ndarray:
    """Number of documents of each line hash by a shard's arrays; 0 for lines it does not hold."""
    prints = np.frombuffer(index["fingerprints"], np.uint32)
    counts = np.frombuffer(index["counts"], np.uint32)
    if not len(prints):
        return np.zeros(len(keys), np.int64)
    table = PerfectHash(np.array(index["sizes"], np.int64), np.frombuffer(index["bits"], np.uint8))
    slots = table.slots(keys)
    held = (slots >= 0) & (prints[slots] == fingerprints(keys))
    return np.where(held, counts[slots].astype(np.int64), 0)


def _common(min_documents: int):
    def rows(probes: pa.Table, index: pa.Table) -> pa.Table:
        """(chunk, its lines that are common, packed)."""
        chunks, lines = probes.column("chunk").to_numpy(), probes.column("line").to_numpy()
        hit = np.zeros(len(lines), bool)
        if len(index):
            hit = probe(index.to_pylist()[0], lines.view(np.uint64)) >= min_documents
        order = np.argsort(chunks[hit], kind="stable")
        chunks, lines = chunks[hit][order], lines[hit][order]
        ids, begins = np.unique(chunks, return_index=True)
        return pa.table(
            {
                "chunk": pa.array(ids, pa.int64()),
                "lines": pa.array([part.tobytes() for part in np.split(lines, begins[1:])][: len(ids)], pa.binary()),
            }
        )

    return rows


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without common lines. Rows come sorted by chunk, answers to its probes first."""
    chunk, common, known = None, set(), {}
    for batch in batches:
        chunks = batch.column("chunk").to_pylist()
        answers = batch.column("lines")
        is_null = batch.column("text").is_null().to_pylist()
        is_answer = answers.is_valid().to_pylist()
        totals, dropped, kept = [], [], []
        for begin, end, data, offsets in pieces(batch.column("text")):
            raw = data.tobytes()
            for row in range(begin, end):
                if chunks[row] != chunk:
                    chunk, common, known = chunks[row], set(), {b"": False}
                if is_answer[row]:
                    common.update(np.frombuffer(answers[row].as_py(), np.int64).tolist())
                    continue
                text = raw[offsets[row - begin] : offsets[row - begin + 1]]
                lines = text.split(b"\n")
                stay = lines
                if common:
                    stay = []
                    for line in lines:
                        key = line_key(line)
                        gone = known.get(key)
                        if gone is None:
                            gone = known[key] = line_hash(key) in common
                        if not gone:
                            stay.append(line)
                totals.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(None if is_null[row] else text if stay is lines else b"\n".join(stay))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").filter(answers.is_null()),
                pa.array(totals, pa.int64()),
                pa.array(dropped, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["row", "n_lines", "n_dropped", "kept_text"],
        )


def line_index(routed: DataFrame) -> DataFrame:
    """One row of arrays per shard, from rows (shard, line, documents)."""
    return routed.groupBy("shard").applyInArrow(_build, INDEX)


def drop_common_lines(
    docs: DataFrame,
    min_documents: int = 10,
    carry: list[str] | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """row (the carried columns, all by default), n_lines, n_dropped, kept_text of every document."""
    carry = docs.columns if carry is None else carry
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]
    chunks = -(-size // chunk_bytes) + 1
    shards = -(-chunks // CHUNKS_PER_SHARD)
    texts = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in carry]).alias("row"),
        F.col("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"),
    )
    found = texts.select("chunk", "text").mapInArrow(_lines, "chunk long, line long, documents long")
    routed = (
        found.groupBy("chunk", "line")
        .agg(F.sum("documents").alias("documents"))
        .withColumn("shard", F.pmod("line", F.lit(shards)))
        .repartition("shard")
    )
    index = line_index(routed)
    answers = (
        routed.groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInArrow(_common(min_documents), "chunk long, lines binary")
    )
    row = texts.schema["row"].dataType.simpleString()
    both = texts.select("chunk", "row", "text", F.lit(None).cast("binary").alias("lines")).unionByName(
        answers.select("chunk", F.lit(None).cast(row).alias("row"), F.lit(None).cast("string").alias("text"), "lines")
    )
    return (
        both.repartition("chunk")
        .sortWithinPartitions("chunk", F.col("lines").isNull())
        .mapInArrow(_drop, f"row {row}, n_lines long, n_dropped long, kept_text string")
    )


def op2_line_dedup(spark, sf_dir):
    kept = drop_common_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), 10, ["doc_id"])
    return kept.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


OP2_SQL = """
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
        from documents
    ), keyed as (
        select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
        from lines
    ), common as (
        select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10
    ), marked as (
        select keyed.*, common.key is not null as gone from keyed left join common using (key)
    )
    select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
    from marked group by doc_id
"""
