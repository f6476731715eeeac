"""Exact Jaccard join of documents by distinct 5-word shingles, and its connected components.

Documents with the same set are one class (found by hash, so copies never meet). Two classes with a
Jaccard similarity of 0.8 differ in at most H = (|a| + |b|) / 9 shingles. The universe of shingles is
dealt to m > H segments by hash, m by size band; a class then has a subset of its shingles per segment,
and two similar classes agree in all but H of them. What is indexed is allocated by cost, as little as
makes the guarantee hold, level by level:

1. of the universe without its commonest shingles, the segments that hold two shingles or more, if they
   are more than H (common shingles, of passages that many documents share, make long lists);
2. else also those that hold one;
3. to 4. else also those of the whole universe, in the same order;
5. else also one-deletion neighbourhoods: a segment's subset, and the subset without each shingle.
   A segment with one shingle then counts 1 against H, a larger one 2;
6. else, which chance makes very rare, every shingle by itself.

If either of two similar classes has enough at a level, both have indexed that level, so they share a
signature, whatever shingles are taken for common: these are found in a sample of documents. A pair lies
in one band, or on either side of a border between bands; each border is a band of its own, for sizes
from 0.8 to 1.25 times the border.

Classes that share a signature are compared with the first of them, not with one another. Candidates are
verified exactly: first by their odd sketches (the parities of the shingles in each cell: two sketches
differ in no more bits than the sets in shingles), then by the sets. Similar ones give components.
Classes that met the same first class and are still in different components are then compared with each
other (the same way), so no link is missed: a pair is left out only if other links connect it. Before
that, classes with too many shingles that none of the others has are set aside; they are like none.

Defined cases: words are lower-cased (A-Z); a text with 1 to 4 words has one shingle, all of it; null
and wordless texts have none and are their own component; rows that share an id are one document of
several texts: any of them may link; every row is reported. Rows with a null id are documents of their
own; a null id is smaller than all others and reported as null. Extra columns are ignored. Shingles and
sets are told apart by 64-bit hashes. A very long text is one array of its task, with some 50 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.shared import NO_ID, broadcast_if_small, order_id, stored
from tableflow.llm.words import BETWEEN_SPACES, LOWER, as_long, gram_hashes, mixed, pieces, words_of

SHINGLE = 5
#: segments per difference that has to be allowed for
SPARE = 1.25
#: rows of a partition of a stored table
ROWS_PER_PARTITION = 100_000
#: documents of the sample for common shingles, how many of them must have one, and how many are kept
SAMPLE = 4000
LEAST_COMMON = 4
COMMON = 100_000

_BORDERS = [4]
while _BORDERS[-1] < 2**40:
    _BORDERS.append(_BORDERS[-1] * 25 // 16)
BORDERS = np.array(_BORDERS)


class Sets:
    """The shingle sets of a piece: sorted distinct hashes, text after text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = words_of(data, offsets, BETWEEN_SPACES, LOWER)
        counts = words.counts()
        starts = words.starts_with_room(SHINGLE)
        text = words.text_of()[starts]
        hashes = gram_hashes(words.hashes, SHINGLE)[starts] if len(starts) else np.zeros(0, np.uint64)
        for size in range(1, SHINGLE):
            short = np.flatnonzero(counts == size)
            if len(short):
                whole = gram_hashes(words.hashes, size)[words.first[short]]
                text = np.concatenate([text, short])
                hashes = np.concatenate([hashes, mixed(whole + np.uint64(size))])
        order = np.argsort(text, kind="stable")
        text, hashes = text[order], hashes[order]
        edges = np.searchsorted(text, np.arange(len(counts) + 1))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            hashes[low:high].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.text, self.hashes = text[new], hashes[new]
        self.first = np.searchsorted(self.text, np.arange(len(counts) + 1))
        self.values = mixed(self.hashes + np.uint64(7))
        self.sizes = np.diff(self.first)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values)])
        total = sums[self.first[1:]] - sums[self.first[:-1]]
        #: names the set; of no meaning for empty ones
        self.prints = mixed(total + self.sizes.astype(np.uint64)).view(np.int64)

    def sketches(self) -> tuple[np.ndarray, np.ndarray]:
        """Odd sketch of each set, of 2 to 4 bits per shingle: 64-bit words, and where each set's begin."""
        words = 1 << np.maximum(0, np.ceil(np.log2(np.maximum(2 * self.sizes, 1))).astype(np.int64) - 6)
        begin = np.concatenate([[0], np.cumsum(words)])
        at = 64 * begin[self.text] + (self.hashes & (64 * words[self.text] - 1).astype(np.uint64)).astype(np.int64)
        odd = np.bincount(at, minlength=64 * begin[-1]) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64), begin

    def signatures(
        self, band: np.ndarray, differences: np.ndarray, common: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(text, signature) in the band of each text, -1 for none; ``common`` marks shingles."""
        segments = np.ceil(SPARE * (differences + 1)).astype(np.uint64)
        count = len(band)
        texts, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        short = band >= 0
        for universe in range(2):
            live = short[self.text] if universe else short[self.text] & ~common
            text, hashes, values = self.text[live], self.hashes[live], self.values[live]
            if not len(text):
                continue
            segment = ((hashes >> np.uint64(32)) * segments[text]) >> np.uint64(32)
            new = np.ones(len(text), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(new)
            part = np.cumsum(new) - 1
            sizes = np.diff(np.append(begin, len(text)))
            total = np.add.reduceat(values, begin)
            owner = text[begin]
            place = mixed(mixed(segment[begin] + np.uint64(1)) + band[owner].astype(np.uint64))

            def sign(level: int, sums: np.ndarray, where: np.ndarray) -> np.ndarray:
                return mixed(sums + where * np.uint64(2 * level + 1))

            large = sizes >= 2
            short = short & (np.bincount(owner[large], minlength=count) <= differences)
            single = ~large & short[owner]
            short = short & (np.bincount(owner, minlength=count) <= differences)
            texts.append(owner[large | single])
            out.append(sign(universe, total, place)[large | single])
            if not universe:
                continue
            near = short[owner]
            texts.append(owner[near])
            out.append(sign(2, total, place)[near])
            cut = (near & large)[part]
            texts.append(text[cut])
            out.append(sign(2, total[part] - values, place[part])[cut])
            short = short & (np.bincount(owner, np.where(large, 2, 1), minlength=count) <= differences)
            alone = short[text]
            texts.append(text[alone])
            out.append(sign(3, values, mixed(band[text].astype(np.uint64)))[alone])
        return np.concatenate(texts), np.concatenate(out)

    def all_signatures(self, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, signature) for the size band of each text and for the borders near it.

        ``common`` has the hashes of common shingles, sorted.
        """
        is_common = np.zeros(len(self.hashes), bool)
        if len(common):
            is_common = common[np.minimum(np.searchsorted(common, self.hashes), len(common) - 1)] == self.hashes
        own = np.searchsorted(BORDERS, self.sizes)  # sizes up to BORDERS[own]
        upper, lower = BORDERS[own], BORDERS[np.maximum(own - 1, 0)]
        texts, out = [], []
        for kind, border, member, differences in (
            (0, own, (self.sizes > 0) & (2 * upper // 9 > 0), 2 * upper // 9),
            (1, own, 5 * self.sizes > 4 * upper, upper // 4),
            (1, own - 1, (own > 0) & (4 * self.sizes <= 5 * lower), lower // 4),
        ):
            band = np.where(member, 2 * border + kind, -1)
            text, signature = self.signatures(band, differences, is_common)
            texts.append(text)
            out.append(signature)
        return np.concatenate(texts), np.concatenate(out)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, data, offsets in pieces(batch.column("text")):
            sets = Sets(data, offsets)
            words, edges = sets.sketches()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(begin, end - begin),
                    batch.column("id").slice(begin, end - begin),
                    batch.column("key").slice(begin, end - begin),
                    pa.array(sets.prints, pa.int64(), mask=sets.sizes == 0),
                    pa.array(sets.sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words)),
                ],
                ["doc_id", "id", "key", "class", "n_shingles", "sketch"],
            )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, class) of each text."""
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column("text")):
            sets = Sets(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [as_long(sets.hashes), as_long(sets.prints[sets.text])], ["shingle", "class"]
            )


def common_shingles(texts: DataFrame) -> np.ndarray:
    """Hashes, sorted, of shingles that several classes of a sample of documents have.

    The sample is of bounded size, and so is the result. It only decides what is indexed first.
    """
    chosen = texts.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    rows = texts.join(F.broadcast(chosen), "id", "left_semi").select("text")
    rows = rows.mapInArrow(_shingle_rows, "shingle long, class long").distinct()
    counts = rows.groupBy("shingle").count().where(F.col("count") >= LEAST_COMMON)
    found = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).select("shingle").collect()
    return np.sort(np.array([row["shingle"] for row in found], np.int64).view(np.uint64))


def _signature_rows(common: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(signature, class), once per class of a batch."""
        for batch in batches:
            met: set[int] = set()
            for _, _, data, offsets in pieces(batch.column("text")):
                sets = Sets(data, offsets)
                text, signature = sets.all_signatures(common)
                fresh = np.zeros(len(sets.sizes), bool)
                for row in np.flatnonzero(sets.sizes).tolist():
                    name = int(sets.prints[row])
                    if name not in met:
                        met.add(name)
                        fresh[row] = True
                keep = fresh[text]
                yield pa.RecordBatch.from_arrays(
                    [as_long(signature[keep]), as_long(sets.prints[text[keep]])], ["signature", "class"]
                )

    return rows


def _star_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first class, other class) of the classes that share a signature; sorted by both."""
    signature_before, first_before = None, 0
    for batch in batches:
        if not len(batch):
            continue
        signature, name = batch.column("signature").to_numpy(), batch.column("class").to_numpy()
        new = np.ones(len(signature), bool)
        new[1:] = signature[1:] != signature[:-1]
        begin = np.flatnonzero(new)
        first = name[begin]
        if signature_before is not None and signature[0] == signature_before:
            first[0] = first_before
        signature_before, first_before = signature[-1], first[-1]
        head = first[np.cumsum(new) - 1]
        other = head != name
        pairs = np.unique(np.stack([head[other], name[other]]), axis=1) if other.any() else np.zeros((2, 0), np.int64)
        yield pa.RecordBatch.from_arrays([as_long(pairs[0]), as_long(pairs[1])], ["a", "b"])


def sketch_distance(one: str, two: str) -> Column:
    """Bits in which two odd sketches differ; the larger one is folded to the size of the other.

    Sizes of similar sets differ by less than a factor of two, so that one fold is enough.
    """

    def folded(name: str) -> Column:
        half = (F.size(name) / 2).cast("int")
        return F.zip_with(F.slice(name, F.lit(1), half), F.slice(name, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    def apart(a: Column, b: Column) -> Column:
        bits = F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        return F.aggregate(bits, F.lit(0), lambda total, x: total + x)

    a, b = F.col(one), F.col(two)
    same, larger = F.size(one) == F.size(two), F.size(one) > F.size(two)
    return F.when(same, apart(a, b)).when(larger, apart(folded(one), b)).otherwise(apart(a, folded(two)))


def may_be_similar(one: str, two: str) -> Column:
    """What the columns (prefix)n_shingles and (prefix)sketch of two classes leave possible."""
    a, b = F.col(f"{one}n_shingles"), F.col(f"{two}n_shingles")
    differences = a + b - 2 * F.ceil((4 * a + 4 * b) / 9)
    near = sketch_distance(f"{one}sketch", f"{two}sketch") <= differences
    return F.when((5 * a >= 4 * b) & (5 * b >= 4 * a), near).otherwise(F.lit(False))


def _set_rows(exploded: bool = False):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets of the wanted classes, as arrays or one row per shingle."""
        for batch in batches:
            wanted = batch.column("class").to_numpy()
            for begin, _, data, offsets in pieces(batch.column("text")):
                sets = Sets(data, offsets)
                own = sets.prints == wanted[begin : begin + len(sets.sizes)]
                keep = own[sets.text]
                values = as_long(sets.hashes[keep])
                if exploded:
                    names = sets.prints[sets.text[keep]]
                else:
                    names = sets.prints[own]
                    edges = np.concatenate([[0], np.cumsum(sets.sizes[own])])
                    values = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [as_long(names), values], ["class", "shingle" if exploded else "shingles"]
                )

    return rows


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that sizes and sketches leave possible."""
    sides = pairs
    for side in ("a", "b"):
        own = classes.select(
            F.col("class").alias(side),
            F.col("n_shingles").alias(f"{side}_n_shingles"),
            F.col("sketch").alias(f"{side}_sketch"),
        )
        sides = sides.join(own, side)
    return sides.where(may_be_similar("a_", "b_")).select("a", "b")


def _texts_of(wanted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """class and a text of it, for the named classes."""
    named = kept(wanted.join(classes.select("class", "id", "key"), "class"))
    return texts.join(broadcast_if_small(named), ["id", "key"]).select("class", "text")


def _private(wanted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """class, private: how many shingles of a class no other of the named classes has."""
    rows = _texts_of(wanted, classes, texts).mapInArrow(_set_rows(exploded=True), "class long, shingle long")
    alone = rows.groupBy("shingle").agg(F.min("class").alias("class"), F.max("class").alias("last"))
    return alone.where("class = last").groupBy("class").agg(F.count("*").alias("private"))


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar."""
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    sets = _texts_of(wanted, classes, texts).mapInArrow(_set_rows(), "class long, shingles array<long>")
    sets = sets.dropDuplicates(["class"])
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_set"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    similar = 100 * common >= 80 * (F.size("a_set") + F.size("b_set") - common)
    return pairs.join(one, "a").join(two, "b").where(similar).select("a", "b")


def kept(df: DataFrame) -> DataFrame:
    """Stored rows, in as few partitions as their number asks for: each file and task has its price."""
    rows = stored(df)
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_PARTITION)))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, which is less, and no v is a u."""
    ends = edges.selectExpr("u as name", "1 as out", "0 as into", "int(v > u) as up")
    ends = ends.union(edges.selectExpr("v", "0", "1", "0"))
    sums = ends.groupBy("name").agg(*[f(c).alias(c) for f, c in ((F.sum, "out"), (F.max, "into"), (F.max, "up"))])
    return sums.where("out > 1 or (out > 0 and into > 0) or up > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """name, root: the least name reachable by links (a, b), for names that have a link.

    Alternating stars: every round points the neighbours of a name to the least one, first the larger
    neighbours, then the smaller. It ends when all links are from a name to a root; the number of
    rounds grows with the logarithm of the longest path.
    """
    edges = kept(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"))
    while not _is_forest_of_stars(edges):
        both = edges.union(edges.select("v", "u"))
        # stored, so that the join can split a name with very many links
        least = broadcast_if_small(kept(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v")  # from a name to a lesser one
        lowest = broadcast_if_small(kept(down.groupBy("u").agg(F.min("v").alias("m"))))
        small = down.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
    found = edges.select(F.col("u").alias("name"), F.col("v").alias("root"))
    return found.union(found.select(F.col("root").alias("name"), "root").distinct())


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"), F.xxhash64(text).alias("key"), text.alias("text")
    )
    features = texts.mapInArrow(
        _feature_rows, "doc_id long, id long, key long, class long, n_shingles long, sketch array<long>"
    )
    features = kept(features)
    classes = kept(
        features.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("id").alias("id"),
            F.min_by("key", "id").alias("key"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
    )
    indexed = _signature_rows(common_shingles(texts))
    signatures = texts.select("text").mapInArrow(indexed, "signature long, class long")
    stars = (
        signatures.repartition("signature")
        .sortWithinPartitions("signature", "class")
        .mapInArrow(_star_rows, "a long, b long")
        .distinct()
    )
    stars = kept(stars)
    of_id = features.where("class is not null and doc_id is not null").select("id", "class").distinct()
    several = of_id.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("last")).where("a <> last")
    same_id = of_id.join(several, "id").select("a", F.col("class").alias("b")).where("a <> b")
    links = kept(_verified(kept(_possible(stars, classes)), classes, texts).unionByName(same_id))
    found = components(links)
    named = classes.select(F.col("class").alias("name")).join(found, "name", "left")
    named = kept(named.select("name", F.coalesce("root", "name").alias("root")))
    # classes that met the same first class, but are apart from it
    met = stars.union(stars.select("a", F.col("a").alias("b")).distinct())
    met = met.join(named.withColumnRenamed("name", "b"), "b")
    apart = met.groupBy("a").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    sized = classes.select(F.col("class").alias("b"), "n_shingles", "sketch")
    met = met.join(apart.select("a"), "a", "left_semi").where("a <> b")
    met = kept(met.join(sized, "b"))
    # a shingle that no other of them has is a difference to each of them; too many leave none similar
    left = met.select(F.col("b").alias("class")).distinct()
    own = _private(left, classes, texts).withColumnRenamed("class", "b")
    met = met.join(own, "b", "left").withColumn("private", F.coalesce("private", F.lit(0).cast("long")))
    met = met.where("5 * private <= n_shingles")
    centres = met.groupBy("b").agg(F.collect_set("a").alias("centres"))
    met = kept(met.join(centres, "b"))
    columns = ("b", "root", "n_shingles", "sketch", "private", "centres")
    one = met.select("a", *[F.col(c).alias(f"x_{c}") for c in columns])
    two = met.select("a", *[F.col(c).alias(f"y_{c}") for c in columns])
    # classes that met several times are compared at one place
    crossed = one.join(two, "a").where("""
        x_b < y_b and x_root <> y_root
        and 9 * (x_private + y_private) <= x_n_shingles + y_n_shingles
        and a = array_min(array_intersect(x_centres, y_centres))
    """)
    crossed = crossed.where(may_be_similar("x_", "y_"))
    crossed = kept(crossed.select(F.col("x_b").alias("a"), F.col("y_b").alias("b")).distinct())
    if crossed.count():
        more = kept(_verified(crossed, classes, texts))
        if more.count():
            roots = named.where("name <> root").select(F.col("name").alias("a"), F.col("root").alias("b"))
            found = components(more.unionByName(roots))
            named = classes.select(F.col("class").alias("name")).join(found, "name", "left")
            named = kept(named.select("name", F.coalesce("root", "name").alias("root")))
    least = classes.join(named, F.col("class") == F.col("name")).groupBy("root").agg(F.min("id").alias("component"))
    of_class = named.join(least, "root").select(F.col("name").alias("class"), "component")
    rows = features.drop("sketch", "key").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.select(
        "doc_id", "n_shingles", F.when(component != NO_ID, component).alias("component_id")
    )


def op4_jaccard(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
