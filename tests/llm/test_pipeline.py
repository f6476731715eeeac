import math
import os
import random
from hashlib import md5

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__
from brute import common_lines, contamination, near_duplicates
from tableflow.llm import registry
from tableflow.llm.mixing import DIGITS

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """documents, labels and benchmark with all that the stages act on, and columns with clashing names."""
    rng = random.Random(9)
    item = " ".join(f"item{k}" for k in range(16))
    texts = []
    for k in range(160):
        own = [f"w{rng.randrange(900)}" for _ in range(60)]
        if k % 8 == 0:
            own[10] = "scum"
        lines = [" ".join(own[:30]), "Common footer" if k % 3 == 0 else f"own line {k}", " ".join(own[30:])]
        texts.append("\n".join(lines))
    texts += [texts[1], texts[1] + " more", texts[2].replace("w1", "v1", 1), texts[3] + "\n" + item]
    texts += [item, item + " w1", "x " * 400 + item, None, None, "", "common footer"]
    rows = [(k, text, "en", f"s{k % 4}" if k % 5 else None, len(text or "")) for k, text in enumerate(texts)]
    rows += [(2, texts[2], "en", "s2", len(texts[2]))] + [(None, texts[4], "en", "s1", len(texts[4]))] * 2
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, COLUMNS)
    extra = ["'r' as row", "1 as id", "2 as key", "3 as score", "'k' as kept_text", "4 as copies", "5 as mix_steps"]
    docs.selectExpr("*", *extra).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, int(k % 8 == 0)) for k in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [(1, item)]


def expected_rows(rows, items):
    """(doc_id, text) after the first four stages; rows with an id, one per id."""
    rows = [row[:2] for row in rows if not row[1] or "scum" not in row[1]]
    rows = [(doc_id, kept) for doc_id, _, _, kept in common_lines(rows, 10)]
    # a row without an id comes before all others
    named = [(-1 if doc_id is None else doc_id, text) for doc_id, text in rows]
    roots = {doc_id for doc_id, _, root in near_duplicates(named) if doc_id == root}
    kept = {row for row in named if row[0] in roots and row[0] >= 0}
    bad = {r[0] for r in contamination(sorted(kept, key=str), items, 13) if r[4]}
    return {row for row in kept if row[0] not in bad}


def test_stages_do_what_brute_force_does(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs.count()
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        assert docs.count() < before or name == "line dedup"
    got = docs.where("doc_id is not null").select("doc_id", "text").collect()
    assert {tuple(row) for row in got} == expected_rows(rows, items) and len(got) == len(set(got))
    assert docs.where("doc_id is null").count() == 1
    sizes = docs.where("text is not null and char_length(text) <> n_chars").count()
    assert sizes == 0


def test_run_repeats_what_the_stages_keep(spark, corpus):
    folder, rows, items = corpus
    out = corpus_pipeline.run(spark, folder).collect()
    kept = expected_rows(rows, items)
    source = {row[0]: row[3] for row in rows}
    sizes = {}
    for doc_id, text in kept:
        sizes[source[doc_id]] = sizes.get(source[doc_id], 0) + len((text or "").encode())
    counts = {}
    for row in out:
        if row["doc_id"] is not None:
            assert (row["doc_id"], row["text"]) in kept
            counts[row["doc_id"]] = counts.get(row["doc_id"], 0) + 1
    # the one row without an id counts for its source
    sizes["s1"] += len(rows[4][1].encode()) - len("\nCommon footer") * (4 % 3 == 0)
    weight = {s: math.sqrt(b) for s, b in sizes.items()}
    for doc_id, _ in kept:
        own = source[doc_id]
        rate = weight[own] / sum(weight.values()) * sum(sizes.values()) / sizes[own] if sizes[own] else 0.0
        draw = int(md5(f"mix|{doc_id}".encode()).hexdigest()[:DIGITS], 16) / 16**DIGITS
        term = total = math.exp(-rate)
        count = 0
        while total <= draw and term > 0:
            count += 1
            term *= rate / count
            total += term
        assert counts.get(doc_id, 0) == count


def test_empty_documents_pass_every_stage(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_queries_are_registered(spark):
    names = __spark_entry__.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_give_the_rows_of_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"  # where the list of op5 decides some rows
    con = duckdb.connect()
    for table in os.listdir(sf_dir):
        con.sql(f"create view {table[:-8]} as select * from '{sf_dir}/{table}'")
    got = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    expected = con.sql(registry.ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = con.sql(f"select {', '.join(columns)} from ({registry.ORACLES[name]})").fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(row)) for row in got.select(*columns).collect())


def test_texts_that_share_an_id_are_not_lost(spark):
    words = [" ".join(f"{c}{k}" for k in range(40)) for c in "abc"]
    rows = [(1, words[0]), (1, words[1]), (1, words[1]), (2, words[1] + " more"), (3, words[2]), (None, words[2]), (None, None)]
    docs = spark.createDataFrame([(*row, "en", "s", 1) for row in rows], COLUMNS)
    near = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    got = sorted(((row["doc_id"], row["text"]) for row in near(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, words[0]), (1, words[1]), (None, words[2]), (None, None)], key=str)
