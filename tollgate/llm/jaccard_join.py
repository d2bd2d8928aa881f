"""N-gram Jaccard join with token-combination prefixes.

Two texts link when the Jaccard similarity of their sets of four-word shingles is at least 85 %. So sets of n and m shingles
that link differ in at most k = (n + m) * 15 / 185 shingles, those that either lacks.

* Sets fall into classes by size. A set takes part in its own class and, where a larger partner may link, in the next one; all sets of
  a class use the k of its largest pair.
* In a class the shingles of a set are dealt by hash into g > k groups. What a group holds of a set is one combination of
  shingles. A shingle that one set lacks spoils one combination, so linked sets have at least g - k combinations in common.
* Combinations have one order for all sets: rare ones first, by the number of sets that have them, then by hash. Of the k + 1 first ones of the
  set whose (k + 1)-th comes earlier, one is common, and it is among the k + 1 first ones of the other set too. This prefix is all that is
  indexed, without those that no other set has. So a set that has k + 1 combinations to itself links with nothing.

A set with too few combinations, because groups got nothing, is dealt again by other bits for partners that have too few as well.

All pairs of a small key are compared. In a large key all sets are compared with one pivot first, then with some more, and
only while they are in different components; a group of near copies soon is one component, so it costs a few
comparisons a member. Two bytes of every shingle are compared first, which is exact in what it rejects. The rest is verified on the whole sets.

Texts with equal sets are one node. Nodes and shingles are 64-bit hashes: of n different ones two are
equal with a chance of about n^2 / 2^65.

Defined cases: words are lower-cased in A-Z; a text of fewer than four words is one shingle; null texts and texts without words have no shingles and
link with nothing; a null id takes part and gets its component's smallest id, or null without one; repeated rows are
equal sets; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import SPACE, ascii_lower, settled, shingles, stored, whole
from tollgate.llm.components import connected_components

SHINGLE = 4
PERCENT = 85
#: Members from which on a key is large.
LARGE = 9
#: The largest size of a class is about so many times its smallest one.
SPAN = 1.5
#: Groups beyond k + 1, as a share of k + 1.
SPARE = 0.25
#: A set that lacks combinations is dealt so often; what still lacks some then shares one key with its like.
DEALS = 5
#: Shingles that are dealt at a time, one set at least.
CHUNK = 1 << 18
#: Expected pivots of a large key, round by round; the last round takes all that are left.
PIVOTS = [0, 16, 256, 2**62]


@dataclass(frozen=True)
class Join:
    shingle: int = SHINGLE
    percent: int = PERCENT
    frequent: int = LARGE

    def classes(self, largest: int) -> np.ndarray:
        """The least size of every class, up to two beyond that of ``largest``. Linked sets are in one class or neighbouring ones."""
        least = [1]
        while len(least) < 3 or least[-3] <= largest:
            least.append(max(least[-1] * 100 // self.percent + 1, int(least[-1] * SPAN)))
        return np.array(least, np.int64)

    def differing(self, largest: np.ndarray) -> np.ndarray:
        """k: the shingles, at most, that one of two linked sets of at most this size has and the other lacks."""
        return 2 * largest * (100 - self.percent) // (100 + self.percent)


def _sets(docs: DataFrame, join: Join) -> Column:
    return F.sort_array(F.array_distinct(shingles(ascii_lower(whole("text")), join.shingle)))


def _row_key() -> Column:
    """Tells rows apart whose ids are missing or repeated; rows that share it are checked by their sets."""
    return F.xxhash64("doc_id", whole("text"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _dealt(values: np.ndarray, sizes: np.ndarray, least: np.ndarray, of_class: np.ndarray, deal: int, join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The combinations of some sets in one class each: keys, the number of the set of every key, and per set those beyond its
    prefix, less than 0 for sets that lack combinations.

    ``values``: the shingles of all sets, set after set, in ascending order as signed numbers.
    """
    keep = join.differing(least[of_class + 1] - 1) + 1
    groups = keep + (keep * SPARE).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bits = values.view(np.uint64) ^ np.uint64(1 << 63)
    if deal:
        bits = _mixed(bits + np.uint64(deal))
        order = np.lexsort((bits, owner))
        values, bits = values[order], bits[order]
    # Groups are ranges of the upper bits, so a set's combinations are stretches of its shingles.
    group = ((bits >> np.uint64(32)) * groups.astype(np.uint64)[owner]) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1]))))
    owner = owner[first]
    kind = _mixed((of_class[owner] * (DEALS + 1) + deal).astype(np.uint64))
    keys = _mixed(np.add.reduceat(_mixed(values.view(np.uint64)), first) + kind)
    return keys, owner, np.bincount(owner, minlength=len(sizes)) - keep


def combination_keys(values: np.ndarray, sizes: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The combinations of sets, set after set: their keys and tags, and how many each set has.

    A tag is 16 times the combinations beyond the prefix, plus a number for class and deal. ``values``: all sets' shingles, ascending; no set is empty.
    """
    least = join.classes(int(sizes.max()))
    own = np.searchsorted(least, sizes, side="right") - 1
    found = []
    for step in (0, 1):
        # The next class matters to sets that may have a partner in it.
        chosen = np.flatnonzero(step * join.percent * least[own + 1] <= 100 * sizes)
        for deal in range(DEALS):
            if not len(chosen):
                break
            inside = np.zeros(len(sizes), bool)
            inside[chosen] = True
            keys, owner, beyond = _dealt(values[np.repeat(inside, sizes)], sizes[chosen], least, own[chosen] + step, deal, join)
            found.append((keys, np.maximum(beyond, 0)[owner] * 16 + step * 8 + deal, chosen[owner]))
            chosen = chosen[beyond < 0]
        last = _mixed(((own[chosen] + step) * (DEALS + 1) + DEALS).astype(np.uint64))
        found.append((last, np.full(len(chosen), step * 8 + DEALS), chosen))
    keys, tags, owner = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.argsort(owner, kind="stable")
    return keys[order].view(np.int64), tags[order].astype(np.int32), np.bincount(owner, minlength=len(sizes))


def _key_lists(sets: pa.ListArray, join: Join) -> Iterator[tuple[pa.ListArray, pa.ListArray]]:
    """Keys and tags of sets, for some of the sets at a time."""
    if not len(sets):
        return
    ends = sets.offsets.to_numpy()[1:] - sets.offsets.to_numpy()[0]
    start, done = 0, 0
    while start < len(sets):
        stop = max(int(np.searchsorted(ends, done + CHUNK, side="right")), start + 1)
        part = sets.slice(start, stop - start)
        sizes = np.diff(part.offsets.to_numpy()).astype(np.int64)
        counts = np.zeros(len(part), np.int64)
        keys, tags = np.zeros(0, np.int64), np.zeros(0, np.int32)
        if sizes.any():
            keys, tags, counts[sizes > 0] = combination_keys(part.flatten().to_numpy(), sizes[sizes > 0], join)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        yield pa.ListArray.from_arrays(offsets, keys), pa.ListArray.from_arrays(offsets, tags)
        start, done = stop, int(ends[stop - 1])


def indexed_texts(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n_shingles, the node (a hash of the set), a row key, a number and the combinations (keys and tags) of every text."""
    names = ["doc_id", "row", "n_shingles", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for keys, tags in _key_lists(batch.column("set"), join):
                part = batch.slice(start, len(keys))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], keys, tags], [*names, "keys", "tags"])
                start += len(keys)

    n = F.size("set").cast("bigint")
    sets = docs.select("doc_id", _row_key().alias("row"), _sets(docs, join).alias("set")).select(
        "doc_id", "row", n.alias("n_shingles"), F.when(n > 0, F.xxhash64("set")).alias("node"), "set")
    layout = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row bigint, n_shingles bigint, node bigint, keys array<bigint>, tags array<int>"
    return sets.mapInArrow(run, layout).withColumn("number", F.monotonically_increasing_id())


def index_keys(own: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """key, node, its size n and the key's members, of keys that at least two nodes have in their prefixes. One text indexes its node."""
    one = own.select("number", "node", "keys", "tags").join(nodes.select("number"), "number", "left_semi")
    rows = one.select("node", F.inline(F.arrays_zip("keys", "tags"))).toDF("node", "key", "tag")
    counted = rows.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key")))
    common = stored(counted.where("members > 1"), "common-keys")
    # What no other set has comes first in the order, so of the others as many are left out as are beyond the prefix.
    own_part = Window.partitionBy("node", "tag")
    ranked = common.withColumns({
        "_rank": F.row_number().over(own_part.orderBy("members", "key")), "_held": F.count(F.lit(1)).over(own_part)})
    keys = stored(ranked.where(F.col("_rank") <= F.col("_held") - F.shiftright("tag", 4)).select("key", "node"), "join-keys")
    # Keys with the same members, told by two hashes of them, ask the same; one of them is kept.
    alike = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"_alike{k}") for k in (0, 1)]
    useful = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), *alike)
    kept = useful.where("members > 1").groupBy("members", "_alike0", "_alike1").agg(F.min("key").alias("key"))
    return keys.join(kept.select("key", "members"), "key").join(nodes.select("node", F.col("n_shingles").alias("n")), "node")


def _pairs(index: DataFrame, labels: DataFrame | None, pivots: tuple[int, int], join: Join) -> DataFrame:
    """Pairs a < b to compare, of sizes that can link.

    At first all pairs of a small key, and a large key's first set with the others. Afterwards, with ``labels``
    (node and component; nodes without a row are their own component), further pivots of the large keys that
    are still apart, with all sets of other components. Which sets are pivots in a round is told by a hash and
    the size of the key; over all rounds every set is one.
    """
    large = index.where(F.col("members") >= join.frequent)
    x, y = ([F.col("node").alias(side), F.col("n").alias(f"n{side}")] for side in "xy")
    sized = 100 * F.least("nx", "ny") >= join.percent * F.greatest("nx", "ny")
    if labels is None:
        small = index.where(F.col("members") < join.frequent)
        met = small.select("key", *x).join(small.select("key", *y), "key").where(sized & (F.col("x") < F.col("y"))).select("x", "y")
        first = large.groupBy("key").agg(F.min(F.struct(*x)).alias("first")).select("key", "first.*")
        met = met.unionAll(large.select("key", *y).join(first, "key").where(sized & (F.col("x") < F.col("y"))).select("x", "y"))
    else:
        marked = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", F.col("node")))
        apart = marked.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        open_keys = marked.join(apart.select("key"), "key")
        turn = F.pmod(F.xxhash64(F.lit("turn"), "node"), F.lit(1 << 30)) / (1 << 30) * F.col("members")
        chosen = open_keys.where((turn >= pivots[0]) & (turn < pivots[1]))
        left = chosen.select("key", *x, F.col("component").alias("cx"))
        right = open_keys.select("key", *y, F.col("component").alias("cy"))
        met = left.join(right, "key").where(sized & (F.col("cx") != F.col("cy"))).select("x", "y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open(pairs: DataFrame, opened: list[DataFrame], docs: DataFrame, nodes: DataFrame, join: Join) -> None:
    """Add to ``opened`` the whole sets of the nodes in ``pairs`` that it lacks. ``nodes``: node and the row that stands for it."""
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    for before in opened:
        ids = ids.join(before.select("node"), "node", "left_anti")
    wanted = stored(ids.join(nodes, "node").select("node", "row"), "wanted")
    texts = docs.select(_row_key().alias("row"), "text").join(wanted, "row")
    # Stored before the test, or the planner would join by it and take the sets of all texts.
    sets = stored(texts.select("node", _sets(texts, join).alias("set")), "opened-sets")
    # With repeated rows the same text may come along again.
    opened.append(sets.where(F.xxhash64("set") == F.col("node")).dropDuplicates(["node"]))


def _beside(pairs: DataFrame, sets: DataFrame, value: Column) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.size("set").alias(f"n{side}"), value.alias(f"s{side}")), side)
    return pairs


def _verified(pairs: DataFrame, opened: list[DataFrame], join: Join) -> DataFrame:
    """Pairs whose whole sets are similar enough.

    Two bytes of every shingle come first. Shingles that share their bytes count as common, so what
    is too few then is too few for certain; only the others move their whole sets.
    """
    sets = reduce(DataFrame.unionAll, opened)
    short = F.array_distinct(F.transform("set", lambda h: (F.pmod(h, F.lit(65536)) - 32768).cast("smallint")))
    near = _beside(pairs, sets, short)
    # A set may hold several shingles with the same bytes; those beyond the first are added on top.
    common = F.size(F.array_intersect("sa", "sb")) + F.greatest(F.col("na") - F.size("sa"), F.col("nb") - F.size("sb"))
    near = stored(near.where(100 * common >= join.percent * (F.col("na") + F.col("nb") - common)).select("a", "b"), "near-pairs")
    exact = _beside(near, sets, F.col("set"))
    common = F.size(F.array_intersect("sa", "sb"))
    return exact.where(100 * common >= join.percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _linked(docs: DataFrame, join: Join) -> DataFrame:
    spark = docs.sparkSession
    own = stored(indexed_texts(docs, join), "indexed-texts")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row", "number")
    nodes = stored(own.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.min_by(F.struct("row", "number"), order).alias("first")
    ).select("node", "rep", "n_shingles", "first.row", "first.number"), "nodes")
    index = settled(spark, lambda: index_keys(own, nodes, join), "join-index")
    labels, links, opened = None, [], []
    for pivots in zip([0, *PIVOTS], PIVOTS):
        pairs = settled(spark, lambda: _pairs(index, labels, pivots, join), "pairs")
        if labels is not None and pairs.isEmpty():
            continue
        _open(pairs, opened, docs, nodes, join)
        links.append(settled(spark, lambda: _verified(pairs, opened, join), "links"))
        labels = settled(spark, lambda: connected_components(reduce(DataFrame.unionAll, links)), "labels")
    marked = own.select("doc_id", "n_shingles", "node").join(labels, "node", "left")
    marked = marked.withColumn("component", F.coalesce("component", "node"))
    # The node numbers are hashes; the smallest document id names the component.
    names = nodes.join(labels, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("rep").alias("component_id"))
    named = marked.join(names, "component", "left")
    return named.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def link_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links. Stored; the tables on the way there are removed."""
    return settled(docs.sparkSession, lambda: _linked(docs, join), "linked-documents")


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The documents, exactly one row of each group: the one with the smallest id, a null id last, then the smallest key.

    A row's key is a 64-bit hash of all its columns, nulls marked; rows with equal keys are copies in every column, of
    which any one stays. Texts without words stay, each.
    """
    key = F.xxhash64(*[part for c in docs.columns for part in (F.col(c), F.col(c).isNull())])
    # Linked by row key instead of id, so that missing and repeated ids tell rows apart like any others.
    linked = link_components(docs.select(key.alias("doc_id"), "text"), join).where("n_shingles > 0")
    members = linked.select(F.col("doc_id").alias("key"), "component_id").distinct()
    rows = docs.select(key.alias("key"), F.col("doc_id").alias("id")).groupBy("key").agg(
        F.any_value("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "copies"))
    found = members.join(rows, "key").groupBy("component_id").agg(first.alias("first"))
    found = stored(found.select(F.col("first.key").alias("keep"), F.col("first.copies").alias("copies")), "kept-rows")
    # The row travels as one value, so its columns cannot clash with those added here.
    has_words = whole("text").rlike(f"[^{SPACE[1:-2]}]")
    boxed = docs.where(has_words).select(F.struct(*docs.columns).alias("row"), key.alias("own"))

    def opened(keys: DataFrame) -> DataFrame:
        return boxed.join(keys.select("keep"), F.col("own") == F.col("keep"))

    kept = docs.where(~has_words).unionAll(opened(found.where("copies = 1")).select("row.*"))
    repeated = found.where("copies > 1")
    if not repeated.isEmpty():
        # Stored before the grouping, so that a key with very many copies can be split in the join.
        copies = stored(opened(repeated).select("own", "row"), "repeated-rows")
        kept = kept.unionAll(copies.groupBy("own").agg(F.any_value("row").alias("row")).select("row.*"))
    return kept
