"""Expressions and small tools that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.sources.shared import remove_folder, shared_folder, write_and_read

#: Runs of these separate words.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables written for the result that is being built; None where they live to the end of the run.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the written rows."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid4().hex}"
    if (written := _written.get()) is not None:
        written.append(path)
    return write_and_read(df, path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Store what ``build`` returns and remove every table stored on the way there.

    Nothing that is used later may read a table stored inside ``build``.
    """
    inner: list[str] = []
    token = _written.set(inner)
    try:
        result = build()
        _written.reset(token)
        return stored(result, name)
    finally:
        if _written.get() is inner:
            _written.reset(token)
        for path in inner:
            remove_folder(spark, path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z alone; for a text of one-byte characters that is plain lower case."""
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_runs(tokens: Column, count: Column, length: int) -> Column:
    """A 64-bit hash of every run of ``length`` words, in text order; empty if there is none.

    Two different runs of one text share a hash with a chance of 2^-64 a pair.
    """
    runs = F.transform(
        F.sequence(F.lit(1), count - F.lit(length - 1)), lambda i: F.xxhash64(F.slice(tokens, i, length))
    )
    return F.when(count >= length, runs).otherwise(F.array().cast("array<bigint>"))


def shingles(text: Column, length: int) -> Column:
    """Hashes of all ``length``-word runs; a shorter text is one run, one without words has none."""
    return let(words(text), lambda w: F.when(
        F.size(w) >= length, word_runs(w, F.size(w), length)
    ).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))


def running_start(df: DataFrame, group: list[str], value: str, key: list[str], name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its group.

    The order inside a group is a fixed shuffle (a hash of ``key``). It has three levels:
    256 parts, 256 parts of each, and the rows of one such part by hash and key. A window sees
    at most 256 totals or one 65,536th of a group, so a group with a third of all rows
    is spread over many tasks.
    """
    digit = F.xxhash64(*key)
    cut = df.withColumns({
        "_h": digit, "_a": F.pmod(digit, F.lit(256)), "_b": F.pmod(F.shiftright(digit, 8), F.lit(256)),
    })
    before = (Window.unboundedPreceding, -1)
    fine = cut.groupBy(*group, "_a", "_b").agg(F.sum(value).alias("_sum"))
    coarse = fine.groupBy(*group, "_a").agg(F.sum("_sum").alias("_sum"))
    coarse_start = coarse.select(*group, "_a", F.coalesce(
        F.sum("_sum").over(Window.partitionBy(*group).orderBy("_a").rowsBetween(*before)), F.lit(0)).alias("_coarse"))
    fine_start = fine.select(*group, "_a", "_b", F.coalesce(
        F.sum("_sum").over(Window.partitionBy(*group, "_a").orderBy("_b").rowsBetween(*before)), F.lit(0)
    ).alias("_fine"))
    inside = Window.partitionBy(*group, "_a", "_b").orderBy("_h", *key).rowsBetween(*before)
    placed = cut.withColumn("_row", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    for starts, parts in ((fine_start, ["_a", "_b"]), (coarse_start, ["_a"])):
        names = [*group, *parts]
        renamed = starts.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(names)], starts.columns[-1])
        same = [placed[c].eqNullSafe(renamed[f"_r{i}"]) for i, c in enumerate(names)]
        on = same[0]
        for more in same[1:]:
            on = on & more
        placed = placed.join(renamed, on).drop(*[f"_r{i}" for i in range(len(names))])
    return placed.select(*df.columns, (F.col("_coarse") + F.col("_fine") + F.col("_row")).alias(name))
