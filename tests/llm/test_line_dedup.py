import numpy as np

from brute import common_lines
from tableflow.llm.line_dedup import PerfectHash, _build, drop_common_lines, line_hash, line_key, probe
import pyarrow as pa


def test_drops_what_brute_force_drops(spark):
    rows = [(k, f"Head \n\n body {k} \n {'Foot'if k % 2 else 'fOOT'}\t\n x\nhead") for k in range(12)]
    rows += [(100, "head"), (101, ""), (102, None), (103, "\n\n"), (104, "É\né"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as lines").repartition(3)
    for least, size in ((10, 4 << 20), (2, 64), (1, 10)):
        got = drop_common_lines(docs, least, chunk_bytes=size)
        found = sorted(map(str, got.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()))
        names = ("doc_id", "n_lines", "n_dropped", "kept_text")
        from pyspark.sql import Row

        assert found == sorted(str(Row(**dict(zip(names, row)))) for row in common_lines(rows, least))
        assert got.select("row.*").columns == docs.columns


def test_empty_table(no_docs):
    assert drop_common_lines(no_docs).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 63, 64, 5000):
        keys = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        table = PerfectHash.of(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))


def test_arrays_of_a_shard_answer_members_and_strangers():
    lines = [line_hash(f"line {k}".encode()) for k in range(1000)]
    rows = pa.table({"shard": [3] * 1500, "line": lines + lines[:500], "documents": [2] * 1500})
    index = _build(rows).to_pylist()[0]
    asked = np.array(lines, np.int64).view(np.uint64)
    assert probe(index, asked).tolist() == [4] * 500 + [2] * 500
    strangers = np.array([line_hash(f"other {k}".encode()) for k in range(1000)], np.int64).view(np.uint64)
    assert not probe(index, strangers).any()


def test_a_very_long_text_and_one_line_everywhere(spark):
    rows = [(k, f"footer\nown {k}") for k in range(500)] + [(900, "footer\nlong line\n" * 100_000)]
    got = drop_common_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 10, ["doc_id"])
    found = {r["row"]["doc_id"]: (r["n_lines"], r["n_dropped"], len(r["kept_text"])) for r in got.collect()}
    assert found[900] == (200_001, 100_000, 100_000 * 10) and found[3] == (2, 1, 5) and len(found) == 501
