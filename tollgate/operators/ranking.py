"""Running totals, quantiles and histograms over a global order, without a one-task sort.

Each function first adds equal values up (before the shuffle), so frequent values cost
nothing. The distinct values are then dealt by range into cells of about equal size; the totals
of the cells are summed in order and handed back to each cell as its offset. The bounds of
the cells are approximate quantiles of the distinct values, a few hundred numbers, found in one
aggregation; they decide how evenly the work is spread, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: About so many distinct values are put in order at a time.
PIECE_ROWS = 50_000
#: Most cells that the distinct values are dealt into; cells grow beyond that.
CELLS = 512
#: Hash digits of a piece of equal keys, and of its parts where many rows share them.
FEW_DIGITS, KEY_DIGITS, ALL_DIGITS = 3, 7, 3
COPIES_PER_CHUNK = 100_000


def _cell_bounds(df: DataFrame, number: Column) -> Column:
    """Numbers that deal the rows of ``df`` into cells, none where one cell is enough."""
    points = F.percentile_approx(number, [i / CELLS for i in range(1, CELLS)], F.lit(20 * CELLS))
    facts = df.agg(points.alias("points"), F.count(F.lit(1)).alias("rows"))
    cells = F.least(F.ceil(F.col("rows") / PIECE_ROWS), F.lit(CELLS))
    every = F.ceil(F.lit(CELLS) / cells).cast("int")
    return facts.select(F.when(cells > 1, F.filter("points", lambda x, i: (i + 1) % every == 0))).scalar()


def running_totals(df: DataFrame, key: str, sums: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, following: Sequence[str] = ()) -> DataFrame:
    """Add ``before_<s>`` (sum over earlier keys) and ``total_<s>`` for each column of ``sums``,
    and ``next_<f>`` (value at the next key, NULL at the last) for each of ``following``.

    ``df`` has one row per (by, key); ``by`` and ``key`` are not NULL.
    """
    number = F.col(key).cast("double")
    cell = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= number)), F.lit(0))
    dealt = df.withColumn("_bounds", _cell_bounds(df, number)).withColumn("_cell", -cell if descending else cell).drop("_bounds")
    order = F.col(key).desc() if descending else F.col(key).asc()

    first = F.max_by if descending else F.min_by
    facts = [F.sum(s).alias(f"_sum_{s}") for s in sums]
    if following:
        facts.append(first(F.struct(*following), key).alias("_first"))
    cells = dealt.groupBy(*by, "_cell").agg(*facts)
    between = Window.partitionBy(*by).orderBy("_cell")
    earlier = between.rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        *by, "_cell",
        *[F.coalesce(F.sum(f"_sum_{s}").over(earlier), F.lit(0)).alias(f"_offset_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(Window.partitionBy(*by)).alias(f"total_{s}") for s in sums],
        *([F.lead("_first").over(between).alias("_ahead")] if following else []),
    )
    within = Window.partitionBy(*by, "_cell").orderBy(order)
    ahead = within.rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.select(
        "*", *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"_within_{s}") for s in sums],
        *([F.lead(F.struct(*following)).over(within).alias("_next")] if following else []),
    )
    joined = ranked.join(offsets, [*by, "_cell"])
    upcoming = F.coalesce("_next", "_ahead") if following else None
    return joined.select(
        *df.columns,
        *[(F.col(f"_offset_{s}") + F.col(f"_within_{s}")).alias(f"before_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
        *[upcoming.getField(f).alias(f"next_{f}") for f in following],
    )


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, as DOUBLE; missing values are left out."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def quantiles_of_counts(counts: DataFrame, points: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per ``by`` group."""
    ranked = running_totals(counts, "value", ["rows"], by)

    def at(position: Column) -> Column:
        inside = (F.col("before_rows") <= position) & (position < F.col("before_rows") + F.col("rows"))
        return F.max(F.when(inside, F.col("value")))

    picks: list[Column] = []
    results: list[Column] = []
    for name, point in points.items():
        position = (F.col("total_rows") - 1) * F.lit(point)
        picks += [
            at(F.floor(position)).alias(f"_low_{name}"),
            at(F.ceil(position)).alias(f"_high_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        results.append((low + (high - low) * F.col(f"_part_{name}")).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *results)


def exact_quantiles(df: DataFrame, value: str, points: dict[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    return quantiles_of_counts(value_counts(df, value, by), points, by)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers at 1.5 IQR, outlier count.

    The per-group quartiles are one row per group; their measured size decides how they are joined.
    """
    counts = value_counts(df, value, [by])
    boxes = quantiles_of_counts(counts, QUARTILES, [by])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return counts.join(boxes, by).groupBy(by).agg(
        F.sum("rows").alias("rows"),
        F.min("value").alias("min"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.max("value").alias("max"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("rows"))).alias("outliers"),
    )


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum as one row."""
    counts = value_counts(df, value)
    quarters = quantiles_of_counts(counts, QUARTILES).select(F.struct(*QUARTILES)).scalar()
    number = F.col(value).cast("double")
    moments = df.agg(
        F.count(value).alias("count"), F.avg(number).alias("mean"), F.stddev_samp(number).alias("std"),
        F.min(number).alias("min"), F.max(number).alias("max"),
    )
    return moments.select(
        "count", "mean", "std", "min", *[quarters.getField(name).alias(name) for name in QUARTILES], "max"
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 50, shared_edges: bool = False) -> DataFrame:
    """Rows per equal-width bin and group, zero bins included; the last bin is closed.

    Edges span each group's own range, or the range of all groups with ``shared_edges``.
    A range of one value becomes one unit wide around it.
    """
    counts = value_counts(df, value, [by])
    ranges = counts.groupBy(by).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    if shared_edges:
        every = Window.partitionBy()
        ranges = ranges.select(by, F.min("low").over(every).alias("low"), F.max("high").over(every).alias("high"))
    flat = F.col("low") == F.col("high")
    ranges = ranges.select(
        by,
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(bins - 1))
    filled = counts.join(F.broadcast(ranges), by).groupBy(by, place.cast("int").alias("bin")).agg(
        F.sum("rows").alias("rows")
    )
    grid = ranges.select(by, "low", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(F.broadcast(filled), [by, "bin"], "left").select(
        by, "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def _unfolded(placed: DataFrame) -> DataFrame:
    """A row per position in [_from, _to), in chunks, so that a row with very many copies is spread over tasks."""
    placed = placed.where("_from < _to")
    chunk = F.lit(COPIES_PER_CHUNK).cast("bigint")
    chunks = placed.withColumn("_chunk", F.explode(F.sequence("_from", F.col("_to") - 1, chunk)))
    return chunks.withColumn("position", F.explode(F.sequence(
        F.col("_chunk"), F.least(F.col("_chunk") + COPIES_PER_CHUNK, F.col("_to")) - 1)))


def _key_starts(pieces: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Where every (key, _piece) starts: rows of earlier keys, then of earlier pieces of the key."""
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("_in_key", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return starts.join(keys.drop("rows"), key).withColumn("_start", F.col("before_rows") + F.col("_in_key"))


def _keys_in_order(counts: DataFrame, key: str, descending: bool) -> DataFrame:
    """Per key its rows, and rows and keys added up before it."""
    return running_totals(
        counts.withColumn("keys", F.col(key) * F.col("rows")), key, ["rows", "keys"], descending=descending)


def _with_totals(placed: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    number = F.col("position") - F.col("before_rows") + 1
    return placed.select(
        *columns, "position", (F.col("before_keys") + number * F.col(key)).alias("running_key"),
        F.col("total_keys").alias("total_key"),
    )


def unique_positions(df: DataFrame, key: str, identity: str, descending: bool = True) -> DataFrame:
    """``global_positions`` of all rows where no two rows share ``identity``, as after a grouping by it.

    Rows are read twice with three columns and hashed by ``identity`` alone.
    """
    hashed = df.withColumn("_id", F.md5(F.coalesce(F.col(identity).cast("string"), F.lit(""))))
    hashed = hashed.withColumn("_piece", F.substring("_id", 1, FEW_DIGITS))
    pieces = hashed.groupBy(key, "_piece").agg(F.count(F.lit(1)).alias("rows"))
    keys = _keys_in_order(df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), key, descending)
    starts = _key_starts(pieces, key, keys).select(key, "_piece", "_start", "before_rows", "before_keys", "total_keys")
    place = F.row_number().over(Window.partitionBy(key, "_piece").orderBy("_id", identity)) - 1
    placed = hashed.withColumn("_place", place).join(starts, [key, "_piece"])
    return _with_totals(placed.withColumn("position", F.col("_start") + F.col("_place")), df.columns, key)


def _all_columns(columns: Sequence[str]) -> Column:
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _few_positions(df: DataFrame, key: str, identity: str, descending: bool, touched: Row) -> DataFrame:
    """Positions of the rows between two keys, a counted few that one task puts in order."""
    order = Window.orderBy(
        F.col(key).desc() if descending else F.col(key).asc(), F.md5(F.coalesce(F.col(identity).cast("string"), F.lit(""))).substr(1, KEY_DIGITS),
        _all_columns(df.columns))
    before = touched["before"] or {"before_rows": 0, "before_keys": 0}
    number = F.row_number().over(order)
    running = F.sum(key).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return df.select(
        "*", (number + F.lit(before["before_rows"]) - 1).cast("bigint").alias("position"),
        (running + F.lit(before["before_keys"])).alias("running_key"), F.lit(touched["total"]).alias("total_key"))


def global_positions(df: DataFrame, key: str, identity: str, descending: bool = True,
                     span: tuple[int, int] | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Number the rows (from 0) by ``key``, equal keys by hashes of ``identity`` and of all columns.

    Adds ``position``, ``running_key`` (keys added up to and including the row) and
    ``total_key``. Equal keys may be most of the data, so they are cut by hash prefix and
    only each piece is put in order; a piece of more than ``piece_rows`` rows is cut again,
    also by a hash of all columns, which parts rows that share an identity. Exact copies
    are counted and unfolded at the end.

    With ``span`` only positions in [start, end) are returned. Keys alone are counted first, when the frame is made; they
    give the first and the last key that the span touches (a few numbers), and only rows between the two are read whole and
    hashed. Where they are many, because of ties, pieces outside the span are dropped before any row is ordered.
    """
    columns = df.columns
    keys = _keys_in_order(df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), key, descending)
    if span:
        begin, end = span
        touched = keys.where((F.col("before_rows") < end) & (F.col("before_rows") + F.col("rows") > begin)).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.min(F.struct("before_rows", "before_keys")).alias("before"), F.max("total_keys").alias("total")).first()
        df = df.where(F.col(key).between(touched["low"], touched["high"]))
        if touched["rows"] <= piece_rows:
            return _few_positions(df, key, identity, descending, touched).where(F.col("position").between(begin, end - 1))
    everything = _all_columns(columns)
    few = F.substring("_id", 1, FEW_DIGITS)
    named = df.withColumn("_id", F.substring(F.md5(F.coalesce(F.col(identity).cast("string"), F.lit(""))), 1, KEY_DIGITS))
    named = named.withColumn("_few", few)
    # Only crowded pieces are cut by all columns; the others are read for key and identity alone.
    sizes = named.groupBy(key, "_few").agg(F.count(F.lit(1)).alias("rows"))
    crowded = sizes.where(F.col("rows") > piece_rows).select(key, "_few")
    finer = F.concat("_id", F.substring("_all", 1, ALL_DIGITS))
    cut = named.join(crowded, [key, "_few"], "left_semi").withColumn("_all", everything).withColumn("_piece", finer)
    whole = named.join(crowded, [key, "_few"], "left_anti").withColumn("_piece", F.col("_few"))
    pieces = sizes.where(F.col("rows") <= piece_rows).select(key, F.col("_few").alias("_piece"), "rows").unionAll(
        cut.groupBy(key, "_piece").agg(F.count(F.lit(1)).alias("rows")))

    starts = _key_starts(pieces, key, keys)
    if span:
        inside = (F.col("_start") < end) & (F.col("_start") + F.col("rows") > begin)
        # A piece has at least one row, so at most end - begin + 1 pieces are left.
        starts = F.broadcast(starts.where(inside))
    facts = ["_start", "before_rows", "before_keys", "total_keys"]
    hashed = whole.withColumn("_all", everything).select(*columns, "_piece", "_id", "_all").unionAll(
        cut.select(*columns, "_piece", "_id", "_all"))
    distinct = hashed.join(starts.select(key, "_piece", *facts), [key, "_piece"]).groupBy(
        *columns, "_piece", "_id", "_all", *facts).agg(F.count(F.lit(1)).alias("_copies"))
    ahead = Window.partitionBy(key, "_piece").orderBy("_id", "_all").rowsBetween(Window.unboundedPreceding, -1)
    placed = distinct.withColumn("_first", F.col("_start") + F.coalesce(F.sum("_copies").over(ahead), F.lit(0)))
    first, stop = F.col("_first"), F.col("_first") + F.col("_copies")
    if span:
        first, stop = F.greatest(first, F.lit(begin)), F.least(stop, F.lit(end))
    placed = placed.withColumns({"_from": first.cast("bigint"), "_to": stop.cast("bigint")})
    return _with_totals(_unfolded(placed), columns, key)
