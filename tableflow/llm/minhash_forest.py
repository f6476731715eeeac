"""Near duplicates by an LSH forest: MinHash labels sorted in several orders, neighbours of a long common prefix.

Documents with the same set of 3-word shingles are one class (found by hash, so copies never meet). A class has
a label in each of ``TREES`` trees: ``DEEP`` MinHash values, each of a hash function of its own, so that two classes
agree in each value with a chance of their Jaccard similarity. The labels of all trees are sorted over range
partitions: a prefix that very many classes share is many partitions, and every sorted run of a tree is one of
its subtrees. Candidates are read off the order:

* neighbours in the order, and their next, whose labels begin with ``SHALLOW`` equal values: no other label of
  the tree has a longer common prefix with theirs;
* all members of a region: the largest subtree around a label that has no more than ``REGION`` members. Where
  labels are sparse it is shallow, down to ``SHALLOW`` values; where they are dense it is as deep as it takes.
  Pairs of a region with more than ``LISTED`` members are compared by their sketches where the region's members meet,
  and only those that may be similar become rows;
* all members of a crowd: more than ``REGION`` labels that agree in all values, as a large group of near copies has.

They are verified: first by odd sketches (no similar
pair is lost), then by the full sets. Similar classes give components. The neighbours of the first few trees come
first; of the other candidates only those are compared whose classes are still in different components. Crowds come last:
by then nearly all of a group is one component, and each class outside it is compared with all others of its crowds, by
sketches, in tiles of two blocks of bounded size.

So every class has a bounded number of candidates but for crowds. Their cost grows with the members that are in the
group's component times those that are not (most are similar to few or none of the group, which only comparing them tells).

Recall: outside dense regions, a pair at the threshold of 0.85 misses all trees with a chance of
(1 - 0.85^5)^32 = 7e-9. In a region of more than ``REGION`` members that share ``SHALLOW`` values, a pair
meets at the depth the region takes, at worst at full depth and misses all trees with a chance of (1 - 0.85^11)^32 = 0.3 %, at
any size of its group. Labels that a border between partitions parts meet in other trees.

Defined cases: words are lower-cased (A-Z); a text with 1 or 2 words has one shingle, all of it; null and
wordless texts have none, are their own component and kept. Rows that share an id are one document of several
texts: any of them may link, and all of them are kept or none. A component goes by its least id; rows without an id
are kept only in components that have none at all (component_id null). A very long text is one array of its
task, with some 50 bytes a word. Ties in the order are broken by a hash of class and label. Extra
columns are ignored. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.jaccard import Sets, components, kept, sketch_distance
from tableflow.llm.shared import NO_ID, broadcast_if_small, order_id, stored, whole_groups
from tableflow.llm.words import BETWEEN_SPACES, LOWER, as_long, gram_hashes, mixed, pieces, words_of

SHINGLE = 3
TREES = 32
#: values of a label, and those that candidates have in common
DEEP = 11
SHALLOW = 5
#: members of a region whose members are all candidates of each other, and of one whose pairs are listed at once
REGION = 64
LISTED = 8
#: members, and shingles of them, in a block of a crowd
BLOCK = 2048
BLOCK_SHINGLES = 1 << 24
#: pairs that a task holds before it hands them on
HELD = 1 << 18
#: neighbours in the order on either side
NEXT = 2
#: trees whose neighbours are compared first
FIRST = 8

#: bytes of a label: its tree, a hash of the first values, 16 bits of each of the others
_TREE, _PREFIX, _REST = 1, 8, 2 * (DEEP - SHALLOW)
WIDTH = _TREE + _PREFIX + _REST
_STEP = np.uint64(0x9E3779B97F4A7C15)


class ShingleSets(Sets):
    """The 3-word shingle sets of a piece: sorted distinct hashes, text after text."""

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
        self.sizes = np.diff(self.first)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.hashes + np.uint64(7)))])
        total = sums[self.first[1:]] - sums[self.first[:-1]]
        #: names the set; of no meaning for empty ones
        self.prints = mixed(total + self.sizes.astype(np.uint64)).view(np.int64)

    def labels(self, rows: np.ndarray) -> np.ndarray:
        """Bytes of the labels of the non-empty sets of some texts: [text, tree, byte]."""
        out = np.zeros((len(rows), TREES, WIDTH), np.uint8)
        if not len(rows):
            return out
        wanted = np.zeros(len(self.sizes), bool)
        wanted[rows] = True
        hashes = self.hashes[wanted[self.text]]
        begin = np.cumsum(self.sizes[rows]) - self.sizes[rows]
        factors = mixed(np.arange(1, TREES * DEEP + 1, dtype=np.uint64)) | np.uint64(1)
        product = np.empty_like(hashes)
        out[:, :, 0] = np.arange(TREES)
        for tree in range(TREES):
            prefix = np.zeros(len(rows), np.uint64)
            rest = np.zeros((len(rows), DEEP - SHALLOW), np.uint16)
            for depth in range(DEEP):
                np.multiply(hashes, factors[tree * DEEP + depth], out=product)
                least = mixed(np.minimum.reduceat(product, begin))
                if depth < SHALLOW:
                    prefix = mixed(prefix * _STEP + least)
                else:
                    rest[:, depth - SHALLOW] = least & np.uint64(0xFFFF)
            out[:, tree, _TREE : _TREE + _PREFIX] = prefix.view(np.uint8).reshape(-1, _PREFIX)
            out[:, tree, _TREE + _PREFIX :] = rest.view(np.uint8).reshape(-1, _REST)
        return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name, size and sketch of each text's set; its labels once per class of a task."""
    met: set[int] = set()
    for batch in batches:
        for begin, end, data, offsets in pieces(batch.column("text")):
            sets = ShingleSets(data, offsets)
            words, edges = sets.sketches()
            fresh = []
            for row in np.flatnonzero(sets.sizes).tolist():
                name = int(sets.prints[row])
                if name not in met:
                    met.add(name)
                    fresh.append(row)
            fresh = np.array(fresh, np.int64)
            labels = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(WIDTH), len(fresh) * TREES, [None, pa.py_buffer(sets.labels(fresh).tobytes())]
            ).cast(pa.binary())
            has = np.zeros(end - begin, np.int64)
            has[fresh] = TREES
            at = np.concatenate([[0], np.cumsum(has)])
            own = [batch.column(name).slice(begin, end - begin) for name in ("doc_id", "id", "key")]
            yield pa.RecordBatch.from_arrays(
                [
                    *own,
                    pa.array(sets.prints, pa.int64(), mask=sets.sizes == 0),
                    pa.array(sets.sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), labels),
                ],
                ["doc_id", "id", "key", "class", "n_shingles", "sketch", "labels"],
            )


def common_prefixes(labels: np.ndarray) -> np.ndarray:
    """Values that each sorted label has in common with the next, 0 if less than ``SHALLOW``."""
    same = labels[1:] == labels[:-1]
    head = same[:, : _TREE + _PREFIX].all(1)
    rest = same[:, _TREE + _PREFIX :: 2] & same[:, _TREE + _PREFIX + 1 :: 2]
    return np.where(head, SHALLOW + np.cumprod(rest, axis=1).sum(1), 0)


def regions_of(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(depth, first place) of the region of each of the sorted labels; at full depth it has all members, however many.

    ``common`` is what each label has in common with the next.
    """
    count = len(common) + 1
    depth_of, first_of = np.full(count, -1, np.int64), np.full(count, -1, np.int64)
    for depth in range(SHALLOW, DEEP + 1):
        run = np.concatenate([[0], np.cumsum(common < depth)])
        small = (depth_of < 0) & ((np.bincount(run)[run] <= REGION) | (depth == DEEP))
        depth_of[small] = depth
        first_of[small] = np.searchsorted(run, run[small])
    return depth_of, first_of


def candidates(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, later place, direct neighbours?) of listed candidates among sorted labels, and members of the larger regions.

    These are (place, name of the region). A crowd has the same name wherever a part of it is met.
    """
    count = len(labels)
    common = common_prefixes(labels)
    depth, first = regions_of(common)
    size = np.bincount(first, minlength=count)[first]
    listed = size <= LISTED
    ones, twos, direct = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    least = np.full(count, DEEP + 1)
    for step in range(1, min(max(LISTED, NEXT + 1), count)):
        least = np.minimum(least[: count - step], common[step - 1 :])  # over the way from i to i + step
        together = (first[:-step] == first[step:]) & listed[:-step]
        one = np.flatnonzero(together | ((least >= SHALLOW) & (step <= NEXT)))
        ones.append(one)
        twos.append(one + step)
        direct.append(np.full(len(one), step == 1))
    members = np.flatnonzero(~listed)
    heads, of = np.unique(first[members], return_inverse=True)
    width = _TREE + _PREFIX + 2 * (depth[heads] - SHALLOW)
    names = [
        int.from_bytes(blake2b(labels[at, :end].tobytes(), digest_size=8).digest(), "little", signed=True)
        for at, end in zip(heads.tolist(), width.tolist(), strict=True)
    ]
    return np.concatenate(ones), np.concatenate(twos), np.concatenate(direct), members, np.array(names, np.int64)[of]


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by label: (a, b, first) of candidate classes, a < b; and (region, a) of larger regions."""
    labels, names = np.zeros((0, WIDTH), np.uint8), np.zeros(0, np.int64)
    for batch in batches:
        if not len(batch):
            continue
        column = batch.column("label").cast(pa.binary(WIDTH))
        own = np.frombuffer(column.buffers()[1], np.uint8)[column.offset * WIDTH :][: len(column) * WIDTH]
        labels = np.concatenate([labels, own.reshape(-1, WIDTH)])
        names = np.concatenate([names, batch.column("class").to_numpy()])
        new = np.ones(len(names), bool)  # a class may come once from each task
        new[1:] = (names[1:] != names[:-1]) | (labels[1:] != labels[:-1]).any(1)
        labels, names = labels[new], names[new]
        one, two, direct, members, regions = candidates(labels)
        first = direct & (labels[one, 0] < FIRST)
        a, b = np.minimum(names[one], names[two]), np.maximum(names[one], names[two])
        pair = np.repeat([True, False], [len(a), len(members)])
        yield pa.RecordBatch.from_arrays(
            [
                as_long(np.concatenate([a, names[members]])),
                pa.array(np.concatenate([b, members]), pa.int64(), mask=~pair),
                pa.array(np.concatenate([first, members < 0])),
                pa.array(np.concatenate([a, regions]), pa.int64(), mask=pair),
            ],
            ["a", "b", "first", "region"],
        )
        labels, names = labels[-REGION:], names[-REGION:]  # what the next batch may belong to


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    return sketch if len(sketch) == words else sketch[:words] ^ sketch[words:]


def _near(
    names: np.ndarray, roots: np.ndarray, sizes: np.ndarray, sides: np.ndarray, sketches: list[np.ndarray]
) -> Iterator[np.ndarray]:
    """Pairs of a region that sizes and sketches leave possible, of classes with different roots, as [2, pair]."""
    widths = np.array([len(sketch) for sketch in sketches])
    # a pair is compared at the width of the smaller sketch
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        rows = rows[np.lexsort([roots[rows], sides[rows]])]
        bits = np.stack([_folded(sketches[row], width) for row in rows.tolist()], 1)
        name, root, size, side, narrow = names[rows], roots[rows], sizes[rows], sides[rows], widths[rows] == width
        half = np.searchsorted(side, 1, "right")
        if side[0] == 0:
            # later rows of other roots
            last, low, high = len(rows), np.zeros(len(rows), np.int64), np.searchsorted(root, root, "right")
            begin = low
        else:
            # rows of side 2 and other roots
            last, begin = half, np.full(half, half)
            low, high = (half + np.searchsorted(root[half:], root[:half], way) for way in ("left", "right"))
        for at in range(last):
            for one, end in ((begin[at], low[at]), (high[at], len(rows))):
                if one >= end:
                    continue
                apart = np.bitwise_count(bits[:, one:end] ^ bits[:, at : at + 1]).sum(0, dtype=np.uint32).astype(np.int64)
                total = size[at] + size[one:end]
                near = apart <= total - 2 * -(-17 * total // 37)
                near &= (20 * size[at] >= 17 * size[one:end]) & (20 * size[one:end] >= 17 * size[at])
                near &= narrow[at] | narrow[one:end]
                if near.any():
                    two = name[one:end][near]
                    yield np.stack([np.minimum(name[at], two), np.maximum(name[at], two)])


def _region_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a region, or a tile of one, that may be similar, of classes with different roots.

    Rows of side 0 are compared with all of the region, those of side 1 with those of side 2.
    """

    def rows(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([as_long(pairs[0]), as_long(pairs[1])], ["a", "b"])

    for table in whole_groups(batches, "region", 5000):
        regions, names, roots, sizes, sides = (
            table.column(name).to_numpy() for name in ("region", "class", "root", "n_shingles", "side")
        )
        column = table.column("sketch").combine_chunks()
        bits, edges = column.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())])
        found, held = [np.zeros((2, 0), np.int64)], 0
        cuts = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1], [True]]))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            sketches = [bits[edges[row] : edges[row + 1]] for row in range(low, high)]
            for pairs in _near(names[low:high], roots[low:high], sizes[low:high], sides[low:high], sketches):
                found.append(pairs)
                held += pairs.shape[1]
                if held >= HELD:
                    yield rows(found)
                    found, held = [np.zeros((2, 0), np.int64)], 0
        yield rows(found)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column("text")):
            sets = ShingleSets(data, offsets)
            edges = pa.array(sets.first, pa.int32())
            arrays = [as_long(sets.prints), pa.ListArray.from_arrays(edges, as_long(sets.hashes))]
            yield pa.RecordBatch.from_arrays(arrays, ["class", "shingles"])


def may_link(one: str, two: str) -> Column:
    """What the columns (prefix)n_shingles and (prefix)sketch leave possible at a similarity of 0.85."""
    a, b = F.col(f"{one}n_shingles"), F.col(f"{two}n_shingles")
    differences = a + b - 2 * F.ceil((17 * a + 17 * b) / 37)
    near = sketch_distance(f"{one}sketch", f"{two}sketch") <= differences
    return F.when((20 * a >= 17 * b) & (20 * b >= 17 * a), near).otherwise(F.lit(False))


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar."""
    sides = pairs
    for side in ("a", "b"):
        own = [F.col(name).alias(f"{side}_{name}") for name in ("n_shingles", "sketch")]
        sides = sides.join(classes.select(F.col("class").alias(side), *own), side)
    possible = kept(sides.where(may_link("a_", "b_")).select("a", "b"))
    wanted = possible.select(F.col("a").alias("class")).union(possible.select("b")).distinct()
    named = kept(wanted.join(classes.select("class", "id", "key"), "class").select("id", "key").distinct())
    # rows that repeat id and text give the same set again
    own = texts.join(broadcast_if_small(named), ["id", "key"], "left_semi").select("text")
    sets = own.mapInArrow(_set_rows, "class long, shingles array<long>").dropDuplicates(["class"])
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_set"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    similar = 100 * common >= 85 * (F.size("a_set") + F.size("b_set") - common)
    return kept(possible.join(one, "a").join(two, "b").where(similar).select("a", "b"))


def _roots(classes: DataFrame, links: DataFrame) -> DataFrame:
    named = classes.select(F.col("class").alias("name")).join(components(links), "name", "left")
    return kept(named.select("name", F.coalesce("root", "name").alias("root")))


def forest_candidates(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, first: candidate classes of the sorted orders; region, class: members of the larger regions)."""
    labels = features.select("class", F.explode("labels").alias("label"))
    labels = labels.withColumn("tie", F.xxhash64("class", "label"))
    ordered = labels.repartitionByRange("label", "tie").sortWithinPartitions("label", "tie").select("class", "label")
    found = ordered.mapInArrow(_candidate_rows, "a long, b long, first boolean, region long")
    found = kept(found.groupBy("a", "b", "region").agg(F.bool_or("first").alias("first")))
    members = found.where("region is not null").select("region", F.col("a").alias("class"))
    return found.where("region is null").select("a", "b", "first"), members


def _sized_members(members: DataFrame, classes: DataFrame, named: DataFrame) -> DataFrame:
    """region, class, root, n_shingles, sketch of the members of regions."""
    sized = classes.select("class", "n_shingles", "sketch")
    return members.join(sized, "class").join(named.withColumnRenamed("name", "class"), "class")


def _near_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of the regions that may be similar and have different roots."""
    rows = rows.select("region", "class", "root", "n_shingles", "sketch", "side")
    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(_region_rows, "a long, b long")


def _tiles(members: DataFrame) -> DataFrame:
    """The members of crowds of several roots, in tiles: any two of a crowd meet in one of them.

    A crowd is dealt to blocks; a tile, which takes the place of the region, is of two blocks, or of one with itself.
    """
    sums = members.groupBy("region").agg(
        F.count("*").alias("size"), F.sum("n_shingles").alias("total"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    sums = kept(sums.where("low <> high").select("region", blocks.alias("blocks")))
    dealt = members.join(broadcast_if_small(sums), "region")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    tile = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.withColumn("side", side.cast("long")).withColumn("region", tile)


def _more_linked(named: DataFrame, pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The roots once those of the pairs are linked whose full sets are similar."""
    if pairs.count():
        more = _linked(pairs, classes, texts)
        if more.count():
            known = named.where("name <> root").select(F.col("name").alias("a"), F.col("root").alias("b"))
            return _roots(classes, more.unionByName(known))
    return named


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"), F.xxhash64(text).alias("key"), text.alias("text")
    )
    features = stored(
        texts.mapInArrow(
            _feature_rows,
            "doc_id long, id long, key long, class long, n_shingles long, sketch array<long>, labels array<binary>",
        )
    )
    rows = features.drop("sketch", "labels")
    classes = kept(
        features.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("id").alias("id"),
            F.min_by("key", "id").alias("key"),
            F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
    )
    pairs, members = forest_candidates(features)
    of_id = rows.where("class is not null and doc_id is not null").select("id", "class").distinct()
    several = of_id.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("last")).where("a <> last")
    same_id = of_id.join(several, "id").select("a", F.col("class").alias("b")).where("a <> b")
    links = _linked(pairs.where("first").select("a", "b"), classes, texts).unionByName(same_id)
    named = _roots(classes, links)
    apart = pairs.where("not first").select("a", "b")
    for side in ("a", "b"):
        own = named.select(F.col("name").alias(side), F.col("root").alias(f"{side}_root"))
        apart = apart.join(own, side)
    apart = apart.where("a_root <> b_root").select("a", "b")
    crowds = kept(members.groupBy("region").count().where(F.col("count") > REGION).select("region"))
    crowded = crowds.count()
    if crowded:
        crowds = broadcast_if_small(crowds)
        crowds, members = members.join(crowds, "region"), members.join(crowds, "region", "left_anti")
    near = _near_pairs(_sized_members(members, classes, named).withColumn("side", F.lit(0).cast("long")))
    named = _more_linked(named, kept(apart.union(near).distinct()), classes, texts)
    if crowded:
        tiles = _tiles(_sized_members(crowds, classes, named))
        named = _more_linked(named, kept(_near_pairs(tiles).distinct()), classes, texts)
    ids = classes.join(named, F.col("class") == F.col("name"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "root").select(F.col("name").alias("class"), "component_id")
    found = rows.join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    keep = F.when(F.col("doc_id").isNull(), component.isNull()).otherwise(F.col("doc_id") == component)
    return found.select("doc_id", "n_shingles", component.alias("component_id"), keep.alias("kept"))


def op11_minhash(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
