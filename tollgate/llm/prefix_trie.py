"""The prefix trie of rebuilt conversations, by union-find over the edges between sorted neighbours.

A conversation is a path: the digests of its turns, one after the other. Distinct paths are sorted over all
partitions. Two neighbours are joined by an edge of the depth of their longest common prefix. Inside a partition the edges are
taken in descending depth; a union of components makes a branching node (several unions of one depth make one), and
the component's path from there down is its chain of nodes without branches. Every figure of a node is a sum, a minimum or a count
over the rows of its interval.

A node is open where its interval reaches the end of a partition and the neighbouring path shares the node. Open nodes (two
chains of a partition, as deep as its two boundary edges) are contracted to their partial figures and merged by
the digest of their path. A row counts a node, or a child, as new where its edge to the row before is less deep; the first row of a
partition looks at the boundary edge, so partial figures add up.

Paths and figures hold digests (128 bits a turn) and sizes; texts never leave their first task. A conversation is one row of about 20 bytes a
turn, which is the bound of what one group holds. Copies are counted before paths are sorted; the ids that end at a
node are hashed in numeric order as a stream, in pieces of ``ENDS`` ids.

Defined cases: null roles and texts are empty; turns of equal number (null first) are in the order of a digest of role and text, repeated
rows are turns of their own; rows without conv_id belong to no conversation and are left out; very long texts count as whole; an empty table
has no node; other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import stored, whole

#: Bytes of a turn in a path.
TURN = 16
#: Conversations share the first turns of the first one of so many.
BLOCK, HEADS = 5, 9
#: Width of the id ranges that are joined to one text before ids are hashed.
ENDS = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path and sizes (UTF-8 bytes of each text) of every rebuilt conversation; one shuffle, of digests."""
    role, text = whole("role"), whole("text")
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    conv = F.col("conv_id").cast("bigint")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % BLOCK).alias("block"), conv.alias("conv_id"),
        F.struct(F.col("turn").isNotNull(), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)), digest.alias("digest"),
                 F.octet_length(text).alias("size")).alias("turn"))
    own = turns.repartition("block").groupBy("block", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("own"))
    # A block has at most nine conversations (around zero).
    first = F.max(F.when(F.col("conv_id") == F.col("block"), F.slice("own", 1, HEADS - 1))).over(Window.partitionBy("block"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    shared = F.coalesce("first", F.array().cast(own.schema["own"].dataType))
    rebuilt = own.withColumns({"first": first, "h": h}).withColumn(
        "turns", F.concat(F.slice(shared, F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own"))))
    return rebuilt.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


def _distinct_paths(paths: DataFrame) -> DataFrame:
    """path, sizes, n_convs, conv_id (the smallest) and the digest of all ids of every distinct path."""
    pieces = paths.groupBy("path", "sizes", F.floor(F.col("conv_id") / ENDS).alias("piece")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names = None, ["path", "sizes", "n", "least", "ends"]
        kinds = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]

        def rows(found: list[list]) -> pa.RecordBatch:
            columns = [*zip(*found)] if found else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            out = []
            for path, sizes, n, least, ids in zip(*[batch.column(c).to_pylist() for c in ("path", "sizes", "n", "least", "ids")]):
                if now is None or now[0] != path:
                    if now is not None:
                        out.append([*now[:4], now[4].hexdigest()])
                    now = [path, sizes, 0, least, hashlib.sha256()]
                elif ids:
                    now[4].update(b",")
                now[2] += n
                now[4].update(ids.encode())
            yield rows(out)
        if now is not None:
            yield rows([[*now[:4], now[4].hexdigest()]])

    ordered = pieces.repartition("path").sortWithinPartitions("path", "piece")
    return ordered.mapInArrow(run, "path binary, sizes array<int>, n bigint, least bigint, ends string")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns at the start that two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // TURN


def _boundaries(parts: DataFrame) -> DataFrame:
    """Depth of the edge before and after every partition, -1 at both ends; a row per partition."""
    ends = parts.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    order = Window.orderBy("part")
    near = ends.select("part", "low", "high", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({
                "part": f.part,
                "before": [-1 if b is None else common_turns(a, b) for a, b in zip(f.low, f.before)],
                "after": [-1 if b is None else common_turns(a, b) for a, b in zip(f.high, f.after)]})

    return near.mapInPandas(run, "part int, before int, after int")


FIGURES = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
NODES = ("depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, "
         "parent_conv_id bigint, node string, parent string")


def partition_nodes(rows: list[tuple[bytes, list[int], int, int, str]], before: int, after: int) -> list[list]:
    """Nodes of sorted distinct paths (path, sizes, copies, least id, digest of ids) between two boundary edges.

    ``node`` names an open node and ``parent`` the open parent of a node; they are None elsewhere.
    """
    last = len(rows) - 1
    lengths = [len(r[0]) // TURN for r in rows]
    bytes_to = [[0, *np.cumsum(r[1], dtype=np.int64).tolist()] for r in rows]
    edge = [before, *(common_turns(rows[i - 1][0], rows[i][0]) for i in range(1, len(rows)))]
    # Per component, at its root: rows, figures, the depth of its node and the unions at that depth.
    root = list(range(len(rows)))
    low, high = root[:], root[:]
    convs, least = [r[2] for r in rows], [r[3] for r in rows]
    leaves = [int((edge[i + 1] if i < last else after) < lengths[i]) for i in root]
    weight = [n * b[-1] for n, b in zip(convs, bytes_to)]
    fresh = [0] * len(rows)  # bytes of the nodes that the rows after the first bring
    top, unions = lengths[:], [0] * len(rows)
    waiting: list[list[int]] = [[] for _ in rows]  # nodes whose parent is still to be made
    out: list[list] = []

    digests: dict[int, list[str]] = {}

    def name(row: int, depth: int) -> str:
        """The digest of the first turns of the first or last path, one turn added at a time."""
        known = digests.setdefault(row, [NOTHING])
        while len(known) <= depth:
            k = len(known) - 1
            known.append(hashlib.sha256(known[-1].encode() + rows[row][0][TURN * k:TURN * (k + 1)]).hexdigest())
        return known[depth][:32]

    def emit(c: int, stop: int) -> None:
        """The nodes of a component from its depth up to ``stop``."""
        first, to = low[c], bytes_to[low[c]]
        for depth in range(top[c], stop - 1, -1):
            reaches = 0 if low[c] == 0 and depth <= before else last if high[c] == last and depth <= after else None
            node = None if reaches is None else name(reaches, depth)
            own = max(depth - 1, 0)
            seen = max(own, before) if first == 0 else own
            saved = weight[c] - convs[c] * to[own] - fresh[c] - (to[-1] - to[min(seen, lengths[first])])
            child = int(lengths[first] > depth and not (first == 0 and before > depth))
            kids = child + (unions[c] if depth == top[c] else 0)
            ends = rows[first][4] if lengths[first] == depth else None
            for k in waiting[c]:
                out[k][7], out[k][9] = (least[c], None) if node is None else (None, node)
            waiting[c] = [len(out)]
            out.append([depth, least[c], convs[c], kids, leaves[c], saved, ends, None, node, None])

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted(range(1, len(rows)), key=lambda i: -edge[i]):
        depth, a, b = edge[i], find(i - 1), find(i)
        for c in (a, b):
            if top[c] > depth:
                emit(c, depth + 1)
                top[c], unions[c] = depth, 0
        if high[a] - low[a] < high[b] - low[b]:
            keep, gone = b, a
        else:
            keep, gone = a, b
        root[gone] = keep
        fresh[keep] = fresh[a] + fresh[b] + bytes_to[i][-1] - bytes_to[i][depth]
        low[keep], high[keep] = low[a], high[b]
        convs[keep], leaves[keep], weight[keep] = convs[a] + convs[b], leaves[a] + leaves[b], weight[a] + weight[b]
        least[keep] = min(least[a], least[b])
        unions[keep] = unions[a] + unions[b] + 1
        if len(waiting[keep]) < len(waiting[gone]):
            waiting[keep], waiting[gone] = waiting[gone], waiting[keep]
        waiting[keep] += waiting[gone]
        waiting[gone] = []
    emit(find(0), 0)
    return out


def _forest(parts: DataFrame) -> DataFrame:
    """Nodes of every partition; open ones under their name."""
    bounded = parts.join(_boundaries(parts), "part")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(map(bytes, f.path), (list(s) for s in f.sizes), f.n.tolist(), f.least.tolist(), f.ends))
        nodes = partition_nodes(rows, int(f.before.iloc[0]), int(f.after.iloc[0]))
        names = [part.split()[0] for part in NODES.split(", ")]
        kinds = dict.fromkeys([*FIGURES[:-1], "parent_conv_id"], "Int64")
        return pd.DataFrame(nodes, columns=names).astype(kinds)

    return bounded.groupBy("part").applyInPandas(run, NODES)


def build_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    distinct = stored(_distinct_paths(rebuilt_paths(conversations)), "paths")
    # The range of a partition is fixed by what is written here.
    parts = stored(distinct.repartitionByRange("path").withColumn("part", F.spark_partition_id()), "path-parts")
    nodes = stored(_forest(parts), "trie")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    opened = nodes.where("node is not null").groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"), F.max("parent").alias("parent"))
    opened = stored(opened, "open-nodes")
    closed = nodes.where("node is null")
    names = opened.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = [*FIGURES, "parent_conv_id"]
    inner = closed.where("parent is null").select(columns)
    outer = closed.where("parent is not null").drop("parent_conv_id").join(names, "parent").select(columns)
    top = opened.join(names, "parent", "left").select(columns)
    return inner.unionAll(outer).unionAll(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
