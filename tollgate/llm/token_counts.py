"""Token counts by byte-pair merging with a heap and a linked list.

Each unit of a text starts as a chain of characters. A heap holds the adjacent pairs that
form a piece of the vocabulary; the pair of lowest rank, leftmost first, is popped and merged until no
pair is left. The count is the initial symbols minus the merges; a character without a piece of its own that no merge
took up counts as its UTF-8 bytes. No identifiers are made.

A text is cut into units only where no piece reaches across, so counts add up exactly: before
a run of word marks, and around line feeds. Counts of units are remembered, ``REMEMBERED`` at most.

Defined cases: null is the empty text; empty texts have no tokens; repeated rows are counted each; an empty table gives no
rows; columns other than doc_id and text are left out.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import whole

MARK = "▁"
REMEMBERED = 1 << 19
LIMIT = 4096


def merge_ranks(model_path: str) -> dict[str, int]:
    """Pieces that merges may form, with their rank; read once, by the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    usable = [i for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    usable.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): rank for rank, i in enumerate(usable)}


def symbols_left(unit: str, ranks: dict[str, int]) -> int:
    """Tokens of one unit: initial symbols minus merges, bytes for characters that no piece covers."""
    n = len(unit)
    if n == 1:
        return 1 if unit in ranks else len(unit.encode())
    ends = list(range(1, n + 1))  # where the symbol that starts here ends, 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(unit[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = ends[left]
        if not right or right >= n or ends[right] != stop:
            continue  # one of the two has changed since
        merges += 1
        ends[left], ends[right] = stop, 0
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(unit[left:ends[stop]])) is not None:
                heapq.heappush(heap, (rank, left, ends[stop]))
        if left > 0:
            first = before[left]
            if (rank := ranks.get(unit[first:stop])) is not None:
                heapq.heappush(heap, (rank, first, stop))
    extra = 0
    if not unit.isascii() or merges < n - 1:
        i = 0
        while i < n:
            if ends[i] == i + 1 and unit[i] not in ranks:
                extra += len(unit[i].encode()) - 1
            i = ends[i]
    return n - merges + extra


class UnitCounts(dict):
    """Counts of units seen lately; a unit is cut further where no piece spans two neighbours."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks
        self.joined = {piece[i:i + 2] for piece in ranks for i in range(len(piece) - 1)}
        # Cuts that hold for this vocabulary; otherwise the whole text is one unit.
        marks_lead = not any(a != MARK and b == MARK for a, b in (pair for pair in self.joined))
        lines_stand = not any("\n" in pair for pair in self.joined)
        self.units = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if marks_lead and lines_stand else r"(?s).+").findall

    def __missing__(self, unit: str) -> int:
        if len(unit) > 1 and unit[-2:] not in self.joined:
            count = self[unit[:-1]] + self[unit[-1]] if len(unit) < 64 else symbols_left(unit, self.ranks)
        else:
            count = symbols_left(unit, self.ranks)
        if len(unit) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = count
        return count

    def of(self, text: str) -> int:
        return sum(map(self.__getitem__, self.units(MARK + text.replace(" ", MARK)))) if text else 0


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""
    ranks = docs.sparkSession.sparkContext.broadcast(merge_ranks(model_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = UnitCounts(ranks.value)
        for batch in batches:
            numbers = pa.array([counts.of(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), numbers], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.octet_length(whole("text")).cast("bigint").alias("n_bytes"), whole("text").alias("text"))
    counted = texts.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
