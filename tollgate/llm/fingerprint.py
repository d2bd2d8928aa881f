"""One-permutation MinHash fingerprints.

Every five-word shingle is hashed once. The hash names one of 256 bins and the bin keeps
its smallest value. An empty bin takes the value of a filled one by optimal densification: bin i
asks the bins hash(i, 1), hash(i, 2), ... and copies the first that is filled, so two
texts that fill the same bins copy alike. The low four bits of a hash of each bin's value and number, one
hexadecimal digit, are stored (a value that many bins of a short text share thus gives them unrelated
digits); equal digits by chance (1 in 16) are taken out of the likeness.

Words are lower-cased. A text of fewer than five words is one shingle; a text without words, or null,
has the empty fingerprint, which is like another empty one (1) and unlike all others (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import let, shingles, stored, whole

SHINGLE = 5
BINS = 256
BITS = 4
#: The largest hash of a bin, below its top bits, marks the bin's end.
LAST = 2**56 - 1
#: Bins asked one by one, then in turns; what still has no answer (a bin in thousands of texts
#: of one shingle) copies its nearest filled bin to the right.
ONE_BY_ONE = 8
TURNS = [(9, 48), (49, 300), (301, 2500)]


def _bins(hashes: Column) -> Column:
    """The smallest hash of every bin, null where there is none, in order of bins.

    The top eight bits of a hash name its bin, so sorted hashes lie bin by bin. One end mark a bin is
    sorted in with them; the first entry of a bin is its smallest hash, or the mark.
    """
    marks = F.split(F.lit(",".join(str((b << 56) + LAST) for b in range(-128, 128))), ",").cast("array<bigint>")
    firsts = let(F.sort_array(F.concat(hashes, marks)), lambda s: F.concat(F.slice(s, 1, 1), F.filter(
        s, lambda x, i: F.shiftright(F.get(s, i - 1), 56) != F.shiftright(x, 56))))
    return F.transform(firsts, lambda x: F.when(x.bitwiseAND(F.lit(LAST)) != LAST, x))


def _asked(i: Column, turn: Column) -> Column:
    return F.pmod(F.xxhash64(i, turn), F.lit(BINS)).cast("int")


def _densified(bins: Column) -> Column:
    def answer(i: Column) -> list[Column]:
        direct = [F.get(bins, _asked(i, F.lit(t))) for t in range(1, ONE_BY_ONE + 1)]
        later = [F.get(F.filter(F.transform(F.sequence(F.lit(first), F.lit(last)), lambda t: F.get(bins, _asked(i, t))),
                                lambda v: v.isNotNull()), 0) for first, last in TURNS]
        nearest = F.get(F.filter(F.transform(F.sequence(F.lit(1), F.lit(BINS)), lambda t: F.get(bins, ((i + t) % BINS).cast("int"))),
                                 lambda v: v.isNotNull()), 0)
        return [*direct, *later, nearest]

    return F.transform(bins, lambda x, i: F.coalesce(x, *answer(i)))


def fingerprint(text: Column) -> Column:
    """256 hexadecimal digits, or the empty string for a text without words."""
    digits = F.lit("0123456789abcdef")

    def packed(hashes: Column) -> Column:
        low = let(_bins(hashes), _densified)
        return F.array_join(F.transform(low, lambda x, i: F.substr(
            digits, F.pmod(F.xxhash64(x, i), F.lit(2**BITS)).cast("int") + 1, F.lit(1))), "")

    return let(shingles(F.lower(text), SHINGLE), lambda h: F.when(F.size(h) == 0, F.lit("")).otherwise(packed(h)))


def likeness(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, from 0 to 1."""
    same = F.size(F.filter(F.zip_with(F.split(left, ""), F.split(right, ""), lambda a, b: a == b), lambda x: x))
    chance = 1 / 2**BITS
    estimate = F.greatest((same / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when((left == "") & (right == ""), F.lit(1.0)).when((left == "") | (right == ""), F.lit(0.0)).otherwise(estimate)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text."""
    return docs.select("doc_id", fingerprint(whole("text")).alias("fingerprint"))


def next_in_order(keys: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``next``, the key of the following row in the order; the last is followed by the first.

    Rows are cut into ranges of about equal size; a window orders each range, and the ends
    of the ranges, one row each, are linked among themselves.
    """
    spark = keys.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cut = stored(keys.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_part").orderBy(*order)
    linked = cut.withColumns({"next": F.lead("key").over(inside), "_first": F.row_number().over(inside) == 1})
    linked = stored(linked, "linked")
    firsts = linked.where("_first").select("_part", F.col("key").alias("_head"))
    around = Window.orderBy("_part")  # one row per range
    ring = firsts.select(
        "_part", F.coalesce(F.lead("_head").over(around), F.first("_head").over(
            around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_over"))
    return linked.join(ring, "_part").select(
        *[c for c in keys.columns], F.coalesce("next", "_over").alias("next"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness; and likeness with the next text.

    The edited text has its last third (floor of n_chars / 3 code points) replaced by as many
    first code points of the next document, all of them where it has fewer. Documents follow each other by falling doc_id, null
    last, and by digest among equal ids; rows equal in both are one document and get equal results.
    """
    text = whole("text")
    own = docs.select("doc_id", text.alias("text"), F.char_length(text).cast("bigint").alias("n_chars"), F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(text, 256)).alias("key"))
    linked = next_in_order(own.select("doc_id", "key", "n_chars").distinct(), [F.desc_nulls_last("doc_id"), F.asc("key")])
    before = linked.select(F.col("next").alias("key"), F.col("key").alias("_to"), F.floor(F.col("n_chars") / 3).alias("_need"))
    own = own.withColumn("fingerprint", fingerprint(F.col("text")))
    # Every document tells the one before it: its fingerprint and as much of its text as that one needs.
    # Both sides use all columns of ``own``, so that it is computed and shuffled by key once.
    told = own.join(before, "key").select(
        F.col("_to").alias("key"), F.col("fingerprint").alias("_next"), F.col("doc_id").alias("next_doc_id"),
        F.substring("text", F.lit(1), F.least("_need", "n_chars").cast("int")).alias("_head"))
    both = own.join(told.dropDuplicates(["key"]), "key")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int"))
    edited = both.withColumn("_edited", F.concat(kept, F.col("_head"))).select(
        "doc_id", "n_chars", "fingerprint", "_next", "next_doc_id", F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(F.col("_edited")).alias("edited_fingerprint"))
    return edited.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"), "next_doc_id")
