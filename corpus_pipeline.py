"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

toxicity (documents predicted toxic go), line dedup (lines found in many documents go), n-gram Jaccard
join (the document of the least id of each group of near duplicates stays), benchmark
decontamination (contaminated documents go), mixing (documents are repeated to target weights).

All stages but the last return the columns they got; line dedup sets ``n_chars`` to the new length. A
null text passes every filter and stays null. Rows that share an id are one document of several texts in the
Jaccard stage: it stays or goes as a whole, each text once. Rows without an id are documents of their own, of which
one per text stays. Extra columns pass unchanged through every stage.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.decontamination import find_contamination
from tableflow.llm.jaccard import jaccard_components
from tableflow.llm.line_dedup import drop_common_lines
from tableflow.llm.mixing import mix_sources
from tableflow.llm.shared import broadcast_if_small, order_id, ready, stored
from tableflow.llm.toxicity import HELD_OUT, fit, fold_of, score_toxicity


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(fold_of() != HELD_OUT))
    clean = score_toxicity(docs, model).where("predicted = 0")
    return clean.select(*[F.col(f"row.{quoted(name)}").alias(name) for name in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(docs, 10, [name for name in docs.columns if name != "text"])
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        size = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(size, F.col("row.n_chars"))
    return kept.select(*[new.get(name, F.col(f"row.{quoted(name)}")).alias(name) for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs).where("not (component_id <=> doc_id)")
    dropped = broadcast_if_small(stored(found.select(order_id().alias("id")).distinct()))
    # a text that several rows of an id have, or several without an id
    copy = F.coalesce(F.xxhash64("text"), F.lit(0))
    names = [F.col(quoted(name)) for name in docs.columns]
    packed = docs.select(F.struct(*names).alias("row"), order_id().alias("id"), copy.alias("copy"))
    packed = packed.join(dropped, "id", "left_anti")
    narrow = docs.select(order_id().alias("id"), copy.alias("copy")).groupBy("id", "copy").count()
    several = stored(narrow.where("count > 1").select("id", "copy"))
    if several.count():
        several = broadcast_if_small(several)
        once = packed.join(several, ["id", "copy"], "left_anti")
        many = packed.join(several, ["id", "copy"], "left_semi").dropDuplicates(["id", "copy"])
        packed = once.unionByName(many)
    return packed.select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark).where("contaminated")
    bad = broadcast_if_small(stored(found.select("id", "key").distinct()))
    names = [F.col(quoted(name)) for name in docs.columns]
    packed = docs.select(F.struct(*names).alias("row"), order_id().alias("id"), F.xxhash64("text").alias("key"))
    return packed.join(bad, ["id", "key"], "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: neither the classifier nor the components can be said in SQL; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus that the stages make of ``documents``; stages are stored in the shared folder."""
    folder = f"{ready(spark).sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return kept
        path = f"{folder}/{number}-{re.sub(r'[^a-z]+', '-', name.lower())}"
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
