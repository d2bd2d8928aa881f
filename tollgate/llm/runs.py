"""Periodic runs of words, found in tiles per octave of the period and stitched together.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at least ``max(12, 2 q)`` words. Periods
below eight are the first octave; the others are [8, 16), [16, 32) and so on. An octave sets anchors every
``step`` words, at most as far apart as its least period, so that every run has an anchor among its first words with a whole period
and more behind it. At an anchor two Z-functions tell, for every period of the octave, how far it holds to the
right and to the left; a tile is a stretch of neighbouring anchors with the words around them that they may read, and is solved
alone. What the tiles find are fragments of runs. They are shuffled by document and period and stitched: fragments of one run overlap by
a period or more, so their union is the run.

Anchors that cannot lie in a run are left out before tiles are made: a run has six equal words in a row a period apart, so some
six-word window near the anchor occurs again at a distance of the octave, and half an octave of windows occurs again at all. Both
are necessary conditions and drop nothing. Texts without any repeated window have no tile and no run.

Rows are told apart by a number of their own, given in a written table, so missing and repeated ids do no harm. The words of texts with
tiles are kept in that table; no other text leaves its task. A task holds one Arrow batch; tiles are small, whatever the length of the
text, but for the largest octaves, whose tiles grow with the period (six times as many words).

Defined cases: a null text is the empty text, without words or runs; very long texts are treated whole; repeated rows are
treated each; an empty table gives no rows; columns other than doc_id and text are left out, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import stored, whole

LEAST_WORDS = 12
#: Equal words in a row, a period apart, that every run has.
WINDOW = 6
#: Anchors of a tile reach over about so many words.
TILE_WORDS = 2048


def octave(number: int) -> tuple[int, int, int]:
    """Least period, period that is too large, and anchor step of an octave."""
    return (1, 8, WINDOW) if number == 0 else (4 << number, 8 << number, 4 << number)


def _repeats(ids: np.ndarray) -> np.ndarray | None:
    """A key of every six-word window, equal for equal windows; None if all differ."""
    if len(ids) < LEAST_WORDS:
        return None
    key = ids[:len(ids) - WINDOW + 1].astype(np.uint64)
    for i in range(1, WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[i:len(ids) - WINDOW + 1 + i].astype(np.uint64)
    key ^= key >> np.uint64(29)
    known, number = np.unique(key, return_inverse=True)
    return None if len(known) == len(key) else number


def _anchors(number: np.ndarray, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave the anchors that may lie in a run."""
    windows = len(number)
    again = np.bincount(number)[number] > 1
    places = np.flatnonzero(again)
    order = np.argsort(number * np.int64(windows) + np.arange(windows))
    keys = (number * np.int64(windows) + np.arange(windows))[order]
    before = np.r_[0, np.cumsum(again)]
    k = 0
    while True:
        low, high, step = octave(k)
        if 2 * low > words:
            return
        # Windows that come again at a distance of the octave.
        wanted = number[places] * np.int64(windows) + places + low
        following = np.searchsorted(keys, wanted)
        found = keys[np.minimum(following, windows - 1)]
        near = (following < windows) & (found < wanted - low + high) & (found < (number[places].astype(np.int64) + 1) * windows)
        hits = np.zeros(windows + 1, np.int64)
        hits[places[near] + 1] = 1
        hits = np.cumsum(hits)
        anchors = np.arange(0, words, step)
        ok = hits[np.minimum(anchors + 1, windows)] > hits[np.clip(anchors - WINDOW, 0, windows)]
        half = low // 2 - WINDOW + 1
        if half > 0:
            ahead = np.minimum(anchors + half, windows)
            behind = np.minimum(anchors - WINDOW + 1, windows)
            full = (ahead - anchors == half) & (before[ahead] - before[np.minimum(anchors, windows)] == half)
            start = np.maximum(behind - half, 0)
            full |= (behind - start == half) & (before[np.maximum(behind, 0)] - before[start] == half)
            ok &= full
        if ok.any():
            yield k, anchors[ok]
        k += 1


def _tiles(ids: np.ndarray) -> list[dict]:
    """Tiles of a text: octave, place of the first word, anchors (from there) and words."""
    number = _repeats(ids)
    tiles = []
    for k, anchors in _anchors(number, len(ids)) if number is not None else ():
        _, high, step = octave(k)
        group = anchors // max(TILE_WORDS, step)
        for part in np.split(anchors, np.flatnonzero(group[1:] != group[:-1]) + 1):
            start, stop = max(0, int(part[0]) - high), min(len(ids), int(part[-1]) + 2 * high)
            tiles.append({"octave": k, "start": start, "anchors": (part - start).tolist(), "words": ids[start:stop].tolist()})
    return tiles


def z_function(words: list[int]) -> list[int]:
    """At each place, how many words from there equal those from the beginning."""
    n = len(words)
    z = [n] * min(n, 1) + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:
            while i + k < n and words[k] == words[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(k: int, anchors: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """Fragments (period, start, stop) of runs around the anchors, in words of the tile.

    A period that is a multiple of a smaller one is left out here: the words of one period
    are then a power, which the Z-function of the anchor shows.
    """
    low, high, _ = octave(k)
    found: dict[int, list[list[int]]] = {}
    for m in anchors:
        ahead = words[m:m + 2 * high]
        right = z_function(ahead)
        # Words before the anchor, read backwards, against those before the anchor plus a period.
        back = words[max(0, m - high):m][::-1]
        beyond = words[m:m + high][::-1]
        # Place len(beyond) - q of the joined list stands before the word m + q.
        left = z_function([*back, -1, *beyond, *back])
        reach = len(back) + 1 + len(beyond)
        ends, top = [0] * (len(ahead) + 1), 0  # furthest place that some period up to here holds to, with that period
        for q in range(1, min(high, len(ahead))):
            if q + right[q] > top:
                for place in range(top + 1, q + right[q] + 1):
                    ends[place] = q
                top = q + right[q]
        for q in range(low, min(high, len(ahead))):
            to_right, to_left = right[q], min(left[reach - q], len(back))
            if to_left + to_right + q < max(LEAST_WORDS, 2 * q):
                continue
            least = ends[q]
            if least and least < q and q % least == 0:
                continue
            start, stop = m - to_left, m + q + to_right
            mine = found.setdefault(q, [])
            if mine and start <= mine[-1][1] - q:
                mine[-1] = [min(start, mine[-1][0]), max(stop, mine[-1][1])]
            else:
                mine.append([start, stop])
    return [(q, *stretch) for q, stretches in found.items() for stretch in stretches]


def reword(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words of a text under test: one in ten texts, by the checksum of the id, becomes periodic from some word on.

    A text without an id stays as it is.
    """
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


TILE = "struct<octave:int,start:int,anchors:array<int>,words:array<int>>"


def _prepared(docs: DataFrame, planted: bool) -> DataFrame:
    """A numbered row per document in a written table: words (joined by a space) and tiles where there are any, else only the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            counts, plain, joined, tiles = [], [], [], []
            for doc_id, text in zip(batch.column("name").to_pylist(), batch.column("text")):
                words = text.as_py().encode().split()  # at the ASCII blanks, of bytes
                if planted:
                    words = reword(words, doc_id)
                numbers: dict[bytes, int] = {}
                ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
                own = _tiles(ids)
                line = b" ".join(words)
                counts.append(len(words))
                plain.append(hashlib.sha256(line).hexdigest())
                joined.append(line.decode() if own else None)
                tiles.append(own or None)
            kind = pa.list_(pa.struct([("octave", pa.int32()), ("start", pa.int32()), ("anchors", pa.list_(pa.int32())), ("words", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(plain, pa.string()),
                 pa.array(joined, pa.string()), pa.array(tiles, kind)], ["row", "doc_id", "n_words", "digest", "words", "tiles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("doc_id").cast("string").alias("name"), whole("text").alias("text"))
    return stored(texts.mapInArrow(run, f"row bigint, doc_id {kind}, n_words bigint, digest string, words string, tiles array<{TILE}>"), "run-tiles")


def _fragments(prepared: DataFrame) -> DataFrame:
    """(row, period, start, stop) of every fragment; the tiles of a long text are dealt over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, periods, starts, stops = [], [], [], []
            for row, tile in zip(batch.column("row").to_pylist(), batch.column("tile")):
                tile = tile.as_py()
                for period, start, stop in solve_tile(tile["octave"], tile["anchors"], tile["words"]):
                    rows.append(row)
                    periods.append(period)
                    starts.append(tile["start"] + start)
                    stops.append(tile["start"] + stop)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(periods, pa.int64()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
                ["row", "period", "start", "stop"])

    tiles = prepared.where("tiles is not null").select("row", F.explode("tiles").alias("tile"))
    dealt = tiles.repartition("row", "tile.octave", "tile.start")
    return dealt.mapInArrow(run, "row bigint, period bigint, start bigint, stop bigint")


def _stitched(fragments: DataFrame) -> DataFrame:
    """Runs (row, start, length, period): fragments of a document and period that overlap by a period are one."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached - F.col("start") >= F.col("period"), 0).otherwise(1)
    marked = fragments.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order))
    runs = marked.groupBy("row", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    # The same words with a multiple of their smallest period are one run.
    return runs.groupBy("row", "start", "stop").agg(F.min("period").alias("period")).select(
        "row", "start", (F.col("stop") - F.col("start")).alias("length"), "period")


def _collapsed(texts: DataFrame) -> DataFrame:
    """(row, collapsed): words, without those that a run holds after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for line, runs in zip(batch.column("words"), batch.column("runs").to_pylist()):
                words = line.as_py().split(" ")
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                out.append(" ".join([words[i] for i in kept]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "collapsed"])

    return texts.select("row", "words", "runs").mapInArrow(run, "row bigint, collapsed string")


def find_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Per document doc_id, n_words, ``runs`` (array of start, length, period by start, then period), and the SHA-256 of the words
    that stay when every run keeps its first period only, joined by a space. ``planted`` makes one text in ten periodic first, as ``reword`` does.
    """
    prepared = _prepared(docs, planted)
    # A text has fewer runs than words.
    per_row = _stitched(_fragments(prepared)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found")
    ).select("row", F.transform("found", lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))
    per_row = stored(per_row, "runs")
    with_runs = prepared.where("words is not null").select("row", "words").join(per_row, "row")
    collapsed = _collapsed(with_runs).select(F.col("row").alias("_row"), F.sha2("collapsed", 256).alias("_collapsed"))
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    facts = per_row.join(collapsed, F.col("row") == F.col("_row"))
    return prepared.select("row", "doc_id", "n_words", "digest").join(facts, "row", "left").select(
        "doc_id", "n_words", F.coalesce("runs", none).alias("runs"),
        F.coalesce("_collapsed", "digest").alias("collapsed_sha256"))


def longest(runs: Column) -> Column:
    """The run of greatest length, of several the one with the smallest start, then period; null without runs."""
    def better(a: Column, b: Column) -> Column:
        # The list is in order of start and period, so only a greater length wins.
        return F.when(a.isNull() | (b["length"] > a["length"]), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
