"""Mixing sources to target weights.

The words of a source are one long stream, cut into blocks of a fixed length. Output shards
of a fixed number of slots are filled with whole blocks:

1. Targets: sources share the words of all documents by weight; a target stops at ``most``
   times its source's words and the excess goes to the others by weight.
2. A source's quota of slots is what its target needs. The slots of all sources are laid out by a
   pseudorandom permutation of all output positions. So the numbers of slots that the sources get in a shard are
   multinomial draws, conditioned on the quotas (draws without replacement): free draws
   would leave small sources far from their targets and could push a document over its limit.
3. The k-th slot of a source takes block perm(k mod n) of its n blocks, perm being the source's own
   pseudorandom permutation: every epoch uses each block once. The last slot is cut to the words still needed.
4. Slots and blocks are joined by source and block number.

Permutations are swap-or-not shuffles: bijections of 0 .. n-1 for any n, computed for one number at a
time from hashes, without a sort or a table.

Defined cases: a null source is a source of its own, last in the order; null and empty texts
have no words and are in no block; repeated rows are separate documents; an empty table gives empty results.
Columns other than doc_id, source and text are left out; ``mixed_documents`` keeps all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import let, running_start, stored, whole, words

#: Weights of the sources in code point order, repeating.
WEIGHTS = [5, 2, 1]
#: A source gives each of its words this many times at most.
MOST = 3
BLOCK = 128
SLOTS_PER_SHARD = 512
ROUNDS = 24
CHUNK = 4096


def permuted(number: Column, size: Column, *seed: Column) -> Column:
    """A pseudorandom bijection of 0 .. size-1 (swap-or-not shuffle)."""
    def swap(x: Column, turn: Column) -> Column:
        key = F.pmod(F.xxhash64(*seed, turn), size)
        return let(F.pmod(key - x, size), lambda partner: F.when(
            F.xxhash64(*seed, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), number.cast("bigint"), lambda x, turn: swap(x, turn))


def source_targets(sizes: DataFrame, weights: list[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source its words and target. ``sizes`` has source and size; one row per source results.

    Sources in the order of their limit per weight are filled up first: with the first k at
    their limits, the level of the rest is (all - limits) / weights. The first k for which the next source
    stays below its limit is the answer.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; a window orders the list of sources.
    order = Window.orderBy(F.asc_nulls_last("source"))
    listed = per_source.withColumn("rank", F.row_number().over(order))
    listed = listed.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(most))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(limit / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = listed.withColumns({"_limit": limit, "_level": level})
    fits = F.col("_limit") >= F.col("_level") * F.col("weight")
    best = F.min_by(F.when(fits, F.col("_level")), F.when(fits, F.struct(F.col("_limit") / F.col("weight"), "rank"))).over(everything)
    # Without a fit every source is at its limit (rounding aside).
    target = F.coalesce(F.least(F.col("_limit"), best * F.col("weight")), F.col("_limit"))
    return levels.select("source", "rank", "source_size", target.alias("target"))


def placed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the place of the first word in the source's stream.

    The order of a stream is a fixed shuffle of its documents. Copies in doc_id, source and text are placed as one and
    unfolded, one behind the other; so copies without words have one start.
    """
    sized = docs.select(
        "doc_id", "source", F.size(words(whole("text"))).cast("bigint").alias("size"), F.xxhash64("text").alias("_text"))
    counted = stored(sized.groupBy("doc_id", "source", "size", "_text").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    all_words = counted.withColumn("_words", F.col("size") * F.col("_n"))
    placed = stored(running_start(all_words, ["source"], "_words", ["doc_id", "_text"], "_first"), "copies")

    def unfolded(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        each = rows.withColumn("_k", F.explode(F.sequence(first, last)))
        return each.select("doc_id", "source", "size", (F.col("_first") + F.col("_k") * F.col("size")).alias("start"))

    # Many copies are unfolded in chunks, so that no task unfolds a third of all rows.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few, many = placed.where(F.col("_n") <= CHUNK), placed.where(F.col("_n") > CHUNK)
    chunks = many.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(CHUNK).cast("bigint"))))
    spread = chunks.repartition(tasks, "doc_id", "source", "_text", "_chunk")
    return unfolded(few, F.lit(0).cast("bigint"), F.col("_n") - 1).unionAll(
        unfolded(spread, F.col("_chunk"), F.least(F.col("_chunk") + CHUNK, F.col("_n")) - 1))


def source_plan(placed: DataFrame, block: int = BLOCK, weights: list[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: target, blocks, words of the last block, its place in an epoch, and the slots it gets."""
    plan = source_targets(placed, weights, most)
    blocks = F.ceil(F.col("source_size") / block)
    plan = plan.withColumns({"blocks": blocks, "wanted": F.round("target").cast("bigint")})
    plan = plan.withColumn("short", block * F.col("blocks") - F.col("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("wanted") / F.col("source_size"))).otherwise(F.lit(0).cast("bigint"))
    plan = plan.withColumn("epochs", epochs)
    # The place k whose block is the last, short one: the shuffle's rounds in reverse undo it.
    plan = plan.withColumn("short_at", F.when(F.col("blocks") > 0, _unpermuted(F.col("blocks") - 1, F.col("blocks"), F.col("rank"))))
    rest = F.col("wanted") - F.col("epochs") * F.col("source_size")
    plain = F.ceil(rest / block)
    # With the short block among the slots, they hold fewer words.
    part = F.when(plain > F.col("short_at"), F.ceil((rest + F.col("short")) / block)).otherwise(plain)
    plan = plan.withColumn("slots", F.coalesce(F.col("epochs") * F.col("blocks") + F.when(rest > 0, part).otherwise(0), F.lit(0).cast("bigint")))
    return plan


def _unpermuted(number: Column, size: Column, *seed: Column) -> Column:
    def swap(x: Column, turn: Column) -> Column:
        key = F.pmod(F.xxhash64(*seed, turn), size)
        return let(F.pmod(key - x, size), lambda partner: F.when(
            F.xxhash64(*seed, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x))

    return F.aggregate(F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)), number.cast("bigint"), lambda x, turn: swap(x, turn))


def slots(plan: DataFrame, block: int = BLOCK, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """One row per output slot: shard, slot, rank of its source, block, epoch and the words used of the block."""
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    laid = plan.withColumns({
        "_from": F.coalesce(F.sum("slots").over(before), F.lit(0)),
        "_all": F.sum("slots").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).where("slots > 0")
    # A source's slots are unfolded in chunks, so that no task unfolds a whole source. The number of tasks
    # is given: the chunks look small before they are unfolded.
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = laid.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1, F.lit(CHUNK).cast("bigint"))))
    spread = chunks.repartition(tasks, "rank", "_chunk")
    each = spread.withColumn("k", F.explode(F.sequence(F.col("_chunk"), F.least(F.col("_chunk") + CHUNK, F.col("slots")) - 1)))
    position = permuted(F.col("_from") + F.col("k"), F.col("_all"), F.lit("positions"))
    each = each.withColumns({
        "_position": position, "block": permuted(F.pmod("k", "blocks"), F.col("blocks"), F.col("rank")),
        "epoch": F.floor(F.col("k") / F.col("blocks")),
    })
    length = F.when(F.col("block") == F.col("blocks") - 1, block - F.col("short")).otherwise(F.lit(block).cast("bigint"))
    in_epoch = F.pmod("k", "blocks")
    ahead = F.col("epoch") * F.col("source_size") + in_epoch * block - F.when(F.col("short_at") < in_epoch, F.col("short")).otherwise(0)
    used = F.greatest(F.least(length, F.col("wanted") - ahead), F.lit(0))
    return each.select(
        F.floor(F.col("_position") / per_shard).alias("shard"), F.pmod("_position", F.lit(per_shard)).alias("slot"),
        "rank", "block", "epoch", used.alias("used"))


def block_parts(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and block that it reaches into; documents without words keep one row without a block."""
    last = F.col("start") + F.col("size") - 1
    numbers = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor(last / block)))
    parts = placed.withColumn("block", F.explode_outer(numbers))
    first = F.greatest(F.col("start"), F.col("block") * block)
    return parts.withColumns({
        "_in_block": first - F.col("block") * block, "first_word": first - F.col("start"),
        "n_words": F.least(last, F.col("block") * block + block - 1) - first + 1,
    })


def mix(docs: DataFrame, block: int = BLOCK, weights: list[float] = WEIGHTS, most: float = MOST,
        per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The mix, one row per document part in a slot, unused parts with a null slot.

    ``words_used`` words of the document from ``first_word`` on (0-based) go to that slot, in the order of ``in_block``.
    """
    placed = stored(placed_documents(docs), "placed")
    return _mixed(placed, stored(source_plan(placed, block, weights, most), "plan"), block, per_shard)


def _beside_plan(placed: DataFrame, plan: DataFrame) -> DataFrame:
    facts = plan.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    return placed.join(facts, placed["source"].eqNullSafe(facts["_source"])).drop("_source")


def _mixed(placed: DataFrame, plan: DataFrame, block: int, per_shard: int) -> DataFrame:
    parts = block_parts(_beside_plan(placed, plan), block)
    # There are as many slots as blocks; the optimizer sees only the few rows they are unfolded from.
    joined = parts.join(slots(plan, block, per_shard).hint("merge"), ["rank", "block"], "left")
    used = F.when(F.col("used") > F.col("_in_block"), F.least(F.col("n_words"), F.col("used") - F.col("_in_block")))
    return joined.select(
        "shard", "slot", F.col("_in_block").alias("in_block"), "epoch", "doc_id", "source", "size", "start", "source_size", "target",
        "first_word", F.coalesce(used, F.lit(0)).cast("bigint").alias("words_used"))


def words_taken(docs: DataFrame) -> DataFrame:
    """Per document: size, its source's size and target, the words that the mix takes, and where the draw puts them:
    the number of its parts in the output and the first and last shard that have one (null: none)."""
    placed = stored(placed_documents(docs), "placed")
    plan = stored(source_plan(placed), "plan")
    mixed = _mixed(placed.where("size > 0"), plan, BLOCK, SLOTS_PER_SHARD)
    drawn = F.when(F.col("words_used") > 0, F.col("shard"))
    taken = mixed.groupBy("doc_id", "source", "size", "start", "source_size", "target").agg(
        F.sum("words_used").alias("taken"), F.count(drawn).alias("n_parts"), F.min(drawn).alias("first_shard"), F.max(drawn).alias("last_shard"))
    # Copies without words have equal starts; no grouping may fold them.
    no = F.lit(None).cast("bigint")
    wordless = _beside_plan(placed.where("size = 0"), plan).withColumns(
        {"taken": F.lit(0).cast("bigint"), "n_parts": F.lit(0).cast("bigint"), "first_shard": no, "last_shard": no})
    columns = ["doc_id", "size", "source_size", "target", "taken", "n_parts", "first_shard", "last_shard"]
    return taken.select(*columns).unionAll(wordless.select(*columns))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row per document and epoch with the words that the epoch takes.

    A document that an epoch takes whole keeps its text. ``n_chars``, if there, follows the text. Documents without
    a word taken are left out. Rows that agree in doc_id, source and text count as one document here.
    """
    text = F.coalesce(F.xxhash64("text"), F.lit(0))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("source", F.lit("\x00")), text)
    # The row travels as one value, so its columns cannot clash with those added here.
    one = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key")).dropDuplicates(["key"])
    used = mix(one.select(F.col("key").alias("doc_id"), F.col("row.source").alias("source"), F.col("row.text").alias("text")))
    takes = used.where("words_used > 0").groupBy(F.col("doc_id").alias("key"), "epoch").agg(
        F.sum("words_used").alias("n"), F.any_value("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("first_word", "words_used"))).alias("ranges"))
    cut = let(words(whole(F.col("row.text"))), lambda w: F.array_join(F.flatten(F.transform(
        F.col("ranges"), lambda r: F.slice(w, (r["first_word"] + 1).cast("int"), r["words_used"].cast("int")))), " "))
    out = one.join(takes, "key").withColumn("text", F.when(F.col("n") == F.col("size"), F.col("row.text")).otherwise(cut))
    changed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
