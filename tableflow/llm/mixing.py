"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture. Its repetition rate is that share of the output size
over its own size, both in bytes of text. A document is repeated as often as a Poisson variable of
that rate says; the variable is the inverse of the distribution function at a uniform number hashed
from a seed and the id, so that a rerun, or a lost executor, gives the same corpus. A rate above
``MAX_RATE``, where the distribution function cannot be tabled, is drawn in equal parts of at most that,
each with a hash of its own: the sum of Poisson variables is a Poisson variable of the summed rate. Copies
are put in the order of another hash: dealt to partitions by it and sorted by it inside each.

Defined cases: a null text counts 0 bytes; a null source is a source of its own; sources without any
byte, or not among given weights, have rate 0; rows that agree in id, source and text are repeated
alike; rows without an id are named by their text; a very long text is repeated like any other. All columns of the input are kept; ``copy``,
``mix_key`` are added, and replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.shared import broadcast_if_small, stored

#: highest rate of one draw; exp(-rate) must stay well above 0
MAX_RATE = 500.0
#: hexadecimal digits of a hash that make a uniform number
DIGITS = 13
#: sources (about a kilobyte each) up to which their rates are broadcast
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """A number from 0 to below 1, from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def source_rates(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    exponent: float = 0.5,
    output_ratio: float = 1.0,
) -> DataFrame:
    """mix_source, mix_rate, mix_parts (draws the rate is dealt to), mix_steps.

    The steps are the distribution function of one draw at 0, 1, ... up to where it is 1.

    Without ``weights``, a source's weight is its size to the power ``exponent``. The output has
    ``output_ratio`` times the bytes of the input on average.
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")
    )
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(exponent))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = stored(sizes.withColumn("weight", F.when(F.col("bytes") > 0, weight).otherwise(F.lit(0.0))))
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    all_bytes, all_weight = F.lit(float(total["bytes"] or 0)), F.lit(float(total["weight"] or 0))
    share = F.col("weight") / all_weight * all_bytes / F.col("bytes") * F.lit(output_ratio)
    rate = F.when((F.col("bytes") > 0) & (all_weight > 0), share).otherwise(0.0)
    rated = sizes.select("mix_source", rate.alias("mix_rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("mix_rate") / F.lit(MAX_RATE)).cast("int"))
    rated = rated.withColumn("mix_parts", parts).withColumn("part_rate", F.col("mix_rate") / F.col("mix_parts"))
    steps = F.expr("""
        aggregate(sequence(1, cast(ceil(part_rate + 12 * sqrt(part_rate) + 30) as int)),
                  named_struct('term', exp(-part_rate), 'sum', exp(-part_rate), 'all', array(exp(-part_rate))),
                  (s, k) -> named_struct(
                      'term', s.term * part_rate / k,
                      'sum', s.sum + s.term * part_rate / k,
                      'all', concat(s.all, array(s.sum + s.term * part_rate / k))),
                  s -> s.all)
    """)
    return stored(rated.withColumn("mix_steps", steps).drop("part_rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    seed: str = "mix",
    exponent: float = 0.5,
    output_ratio: float = 1.0,
) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, with ``copy`` (1, 2, ...) and ``mix_key``."""
    rates = broadcast_if_small(source_rates(docs, weights, exponent, output_ratio), BROADCAST_SOURCES)
    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in ("copy", "mix_key")]
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    drawn = docs.select(
        F.struct(*kept).alias("row"),
        F.col("source").alias("of_source"),
        uniform(F.lit(seed), id_text).alias("draw"),
        id_text.alias("id_text"),
    ).join(rates, F.col("of_source").eqNullSafe(F.col("mix_source")), "inner")
    first = F.size(F.filter("mix_steps", lambda step: step <= F.col("draw")))

    def add_part(total: Column, part: Column) -> Column:
        own = uniform(F.lit(seed), F.lit("part"), part.cast("string"), F.col("id_text"))
        return total + F.size(F.filter("mix_steps", lambda step: step <= own))

    every = F.aggregate(F.sequence(F.lit(2), F.col("mix_parts")), first, add_part)
    count = F.when(F.col("mix_parts") == 1, first).otherwise(every)
    copies = drawn.withColumn("copies", count).where("copies > 0").select(
        "row", "id_text", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    place = F.concat_ws("|", F.lit(seed), F.lit("order"), "id_text", F.col("copy").cast("string"))
    keyed = copies.select("row.*", "copy", F.md5(place).alias("mix_key"))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


def op9_mixing(spark, sf_dir):
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = """
    with recursive sizes as (
        select source, sum(strlen(coalesce(text, ''))) as bytes from documents group by source
    ), weighted as (
        select source, bytes, case when bytes > 0 then pow(cast(bytes as double), 0.5) else 0.0 end as weight
        from sizes
    ), rates as (
        select source, case when bytes > 0 then
            weight / (select sum(weight) from weighted) * cast((select sum(bytes) from weighted) as double)
            / cast(bytes as double) else 0.0 end as rate
        from weighted
    ), parted as (
        select source, greatest(1, cast(ceil(rate / 500.0) as int)) as parts,
               rate / greatest(1, cast(ceil(rate / 500.0) as int)) as rate
        from rates
    ), steps as (
        select source, rate, 0 as k, exp(-rate) as term, exp(-rate) as total from parted
        union all
        select source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
        from steps where k < ceil(rate + 12 * sqrt(rate) + 30)
    ), tables as (
        select source, list(total) as totals from steps group by source
    ), named as (
        select *, coalesce(cast(doc_id as varchar), md5(text), '') as id_text from documents
    ), drawn as (
        select d.*, totals, unnest(range(1, parts + 1)) as part
        from named d join parted p on d.source is not distinct from p.source
            join tables t on d.source is not distinct from t.source
    ), counted as (
        select doc_id, text, lang, source, n_chars, id_text, part, len(list_filter(totals,
            lambda total: total <= cast('0x' || substr(md5('mix|' || case when part = 1 then '' else 'part|' || part || '|' end
                || id_text), 1, 13) as bigint) / 4503599627370496.0)) as copies
        from drawn
    ), summed as (
        select doc_id, text, lang, source, n_chars, id_text, count(*) filter (where part = 1) as times,
               cast(sum(copies) // count(*) filter (where part = 1) as bigint) as copies
        from counted group by doc_id, text, lang, source, n_chars, id_text
    )
    select doc_id, text, lang, source, n_chars, cast(copy as int) as copy,
           md5('mix|order|' || id_text || '|' || copy) as mix_key
    from (select *, unnest(range(1, copies + 1)) as copy
          from (select *, unnest(range(times)) from summed) where copies > 0)
"""
