"""Benchmark decontamination by winnowing, in DataFrame functions only.

Arrays are built column on column and exploded by ``explode_outer``: for ``explode`` the optimizer adds
a filter on the array, into which it copies the whole chain of lambdas, one inside the other.

A text's fingerprints are the least k-gram hashes of every w neighbouring k-grams. Two texts that
share k + w - 1 words in a row share such a neighbourhood, so they share a fingerprint: with k + w - 1
= 13, no shared window of 13 words is missed. Documents and items meet by an equi-join of
fingerprints; only documents that share one are read again, aligned with the items at the hits, and
the hits extended word by word. Items of fewer words are searched the same way at their own length.

Defined cases: a null or wordless document has no words and no hits; an item without words has no
window; rows that agree in id and text are reported as often as they occur; an item id that repeats
counts once; a null item id is left out of the lists. A text that repeats an item's words many times has a row per
place, not an array of places; a very long text is one row with an array of its words and hashes. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.native import plain_words
from tableflow.llm.shared import broadcast_if_small, order_id, stored

WINDOW = 13
GRAM = 5
#: rows of the items' fingerprints (16 bytes each) up to which they are broadcast
BROADCAST_ROWS = 100_000


def grams(hashes: str, length: int) -> Column:
    """Hash of each run of ``length`` values of an array column; fewer values have none."""
    values = F.transform(
        hashes, lambda x, i: F.xxhash64(F.lit(length), x, *[F.get(F.col(hashes), i + k) for k in range(1, length)])
    )
    return F.slice(values, F.lit(1), F.greatest(F.size(hashes) - F.lit(length - 1), F.lit(0)))


def _winnow(rows: DataFrame, values: str, width: int, into: str) -> DataFrame:
    """Adds the least of every ``width`` neighbouring values; fewer values have none.

    Minima of 1, 2, 4, ... neighbours, each from two of the last: a slice per place would copy the
    whole array every time.
    """

    def least(name: str, apart: int) -> Column:
        return F.transform(name, lambda x, i: F.least(x, F.get(F.col(name), i + apart)))

    rows, held, span = rows.withColumn(into, F.col(values)), into, 1
    while 2 * span <= width:
        rows = rows.withColumn(f"{into}_{span}", least(held, span))
        held, span = f"{into}_{span}", 2 * span
    if span < width:
        rows = rows.withColumn(f"{into}_last", least(held, width - span))
        held = f"{into}_last"
    count = F.greatest(F.size(values) - F.lit(width - 1), F.lit(0))
    return rows.withColumn(into, F.array_distinct(F.slice(held, F.lit(1), count)))


def split_of(span: int) -> tuple[int, int]:
    """k and w with k + w - 1 = span."""
    gram = min(GRAM, span)
    return gram, span - gram + 1


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, item (its distinct words), span: the words of a window of it."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("item"))
    return items.where(F.size("item") > 0).distinct().withColumn("span", F.least(F.lit(window), F.size("item")))


def _fingerprints(rows: DataFrame, words: str, spans: list[int]) -> DataFrame:
    """Adds ``prints``: the fingerprints for every span."""
    rows = rows.withColumn("hashes", F.transform(words, lambda word: F.xxhash64(word)))
    parts = []
    for span in spans:
        gram, width = split_of(span)
        rows = rows.withColumn(f"grams{span}", grams("hashes", gram))
        rows = _winnow(rows, f"grams{span}", width, f"prints{span}")
        parts.append(f"prints{span}")
    return rows.withColumn("prints", F.array_distinct(F.concat(*parts)))


def _candidates(texts: DataFrame, items: DataFrame, spans: list[int]) -> DataFrame:
    """doc_id, id, key, n_words, copies (rows of that id and text), hit: shares a fingerprint."""
    printed = None
    for span in spans:
        own = _fingerprints(items.where(F.col("span") == span), "item", [span])
        own = own.select(F.explode_outer("prints").alias("print")).where("print is not null")
        printed = own if printed is None else printed.unionByName(own)
    printed = stored(printed.distinct().withColumn("hit", F.lit(True)))
    printed = broadcast_if_small(printed, BROADCAST_ROWS)
    rows = texts.withColumn("words", plain_words(F.col("text"))).drop("text")
    rows = _fingerprints(rows, "words", spans)
    # one row without a fingerprint per document, so that none is lost
    prints = F.concat(F.array(F.lit(None).cast("long")), F.col("prints"))
    rows = rows.select("doc_id", "id", "key", F.size("words").alias("n_words"), F.explode_outer(prints).alias("print"))
    return rows.join(printed, "print", "left").groupBy("doc_id", "id", "key", "n_words").agg(
        F.count(F.when(F.col("print").isNull(), 1)).alias("copies"), F.max(F.coalesce("hit", F.lit(False))).alias("hit")
    )


def _occurrences(texts: DataFrame, items: DataFrame, spans: list[int]) -> DataFrame:
    """id, key, item_id, first, end: the places of the words of each occurrence of a window of an item."""
    docs = texts.select("id", "key", plain_words(F.col("text")).alias("words")).distinct()
    found = None
    for span in spans:
        gram, width = split_of(span)
        own = items.where(F.col("span") == span).withColumn("hashes", F.transform("item", lambda x: F.xxhash64(x)))
        own = _winnow(own.withColumn("grams", grams("hashes", gram)), "grams", width, "prints")
        own = own.select("item_id", "item", "span", "prints", F.posexplode_outer("grams").alias("item_at", "gram"))
        own = own.where(F.array_contains("prints", F.col("gram"))).drop("prints")
        mine = docs.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
        mine = mine.withColumn("grams", grams("hashes", gram))
        mine = mine.select("id", "key", F.posexplode_outer("grams").alias("at", "gram"))
        hits = mine.join(own, "gram").select(
            "id", "key", "item_id", "item", "span", (F.col("at") - F.col("item_at")).alias("shift")
        )
        found = hits if found is None else found.unionByName(hits)
    aligned = found.distinct().join(docs, ["id", "key"])
    low = F.greatest(F.lit(0), F.col("shift"))
    size = F.least(F.size("words"), F.col("shift") + F.size("item")) - low
    aligned = aligned.withColumn("low", low).withColumn("size", size).where(F.col("size") >= F.col("span"))
    mine = F.slice("words", F.col("low") + 1, F.col("size"))
    other = F.slice("item", F.col("low") - F.col("shift") + 1, F.col("size"))
    aligned = aligned.withColumn("same", F.zip_with(mine, other, lambda a, b: a == b)).drop("words", "item")
    starts = F.filter(
        F.sequence(F.lit(0), F.size("same") - F.col("span")),
        lambda at: F.forall(F.slice("same", at + 1, F.col("span")), lambda same: same),
    )
    found = aligned.select("id", "key", "item_id", "low", "span", F.explode_outer(starts).alias("start"))
    first = F.col("low") + F.col("start")
    return found.where("start is not null").select(
        "id", "key", "item_id", first.alias("first"), (first + F.col("span")).alias("end")
    )


def _covered(found: DataFrame) -> DataFrame:
    """id, key, n_hit: how many places the occurrences of each text cover.

    They are run through in order, each adding what lies beyond all before it.
    """
    spans = found.groupBy("id", "key", "first").agg(F.max("end").alias("end"))
    before = Window.partitionBy("id", "key").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.greatest("first", F.max("end").over(before))
    added = spans.select("id", "key", F.greatest(F.lit(0), F.col("end") - begin).alias("added"))
    return added.groupBy("id", "key").agg(F.sum("added").alias("n_hit"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, id, key, n_words, n_hit, items (item ids as sorted strings), contaminated per document.

    ``id`` and ``key`` are the id without null and a hash of the text, to join results by.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"), F.xxhash64("text").alias("key"), "text"
    )
    items = _items(benchmark, window)
    spans = sorted(row["span"] for row in items.select("span").distinct().collect())  # at most ``window``
    candidates = stored(_candidates(texts, items, spans or [window]))
    hit = broadcast_if_small(stored(candidates.where("hit").select("id", "key").distinct()))
    found = stored(_occurrences(texts.join(hit, ["id", "key"], "left_semi"), items, spans or [window]))
    named = found.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    rows = candidates.join(_covered(found).join(named, ["id", "key"]), ["id", "key"], "left")
    rows = rows.withColumn("copy", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id",
        "id",
        "key",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def op8_decontamination(spark, sf_dir):
    found = find_contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP8_SQL = f"""
    with items as (
        select item_id, w, least(13, len(w)) as n from (select item_id, {_SQL_WORDS} as w from benchmark)
        where len(w) > 0
    ), item_windows as (
        select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as words
        from (select *, unnest(range(1, len(w) - n + 2)) as i from items)
    ), docs as (
        select doc_id, {_SQL_WORDS} as w from documents
    ), doc_windows as (
        select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as words
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
              from docs, (select distinct n from items) where len(w) >= n)
    ), hits as (
        select doc_id, item_id, n, i from doc_windows join item_windows using (n, words)
    ), covered as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id
    ), named as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
        from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
    )
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(names, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from docs d left join covered using (doc_id) left join named using (doc_id)
"""
