"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

The merge list alone fixes how far a character can influence tokens to its left. A merge
is undone only by an earlier merge that overlaps its right end, which may itself depend on a still
earlier one further right; ``sufficient_lookahead`` adds up the longest such chain. That is the bound for any text.
What a given text needs is mostly far less: ``WordTransducer`` follows the chains that its held symbols allow, from
merges that may still cross their end leftwards over merges of rising rank, emits the tokens that begin before all of
them, and drops what it has emitted: its memory does not grow with the text.

The decoder is a state machine from ids to bytes to text: it keeps at most the bytes of one
unfinished character between calls.

Defined cases: null is the empty text, which has no ids; special tokens' strings in a text become
their ids; repeated rows are encoded each; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tollgate.llm.common import whole

REMEMBERED = 1 << 19
#: Words and held bytes from this length on are not remembered.
SHORT = 64
#: A merge is one number, its rank above its token's id: numbers compare like ranks.
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
NO_MERGE = 1 << 62
#: Characters of a text that are handled at a time; cut at white space.
PIECE = 1 << 16
#: Bytes of a word that the transducer gets at first.
STEP = 8
#: Symbols from which on a chain is merged with a heap.
LONG = 48
#: White space of the word pattern.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    tokens: list[str]
    merges: dict[tuple[int, int], int]
    inner: list[int]
    last: list[int]
    special: dict[str, int]
    lookahead: int
    suffix: str


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """Symbols that must be known beyond a token's start before the token is certain.

    ``reach[r]``: how far right of its own end merge r depends on the text. It depends on earlier
    merges that start inside it and end beyond it, and on what its two parts depend on.
    """
    reach: dict[str, int] = {}
    overlap: dict[str, int] = {}  # string -> most symbols beyond it that an earlier merge starting with it depends on
    widest = 1
    for left, right in merges:
        token = left + right
        ends = token.endswith(suffix)
        body = token.removesuffix(suffix)
        size = len(body)
        own = 0
        if not ends:
            own = max(reach.get(right, 0), reach.get(left, 0) - len(right), 0)
            for k in range(1, size):
                own = max(own, overlap.get(body[k:], 0))
        reach[token] = own
        for k in range(1, size):
            beyond = size - k + own
            if overlap.get(body[:k], 0) < beyond:
                overlap[body[:k]] = beyond
        widest = max(widest, size + own)
    return widest


def read_vocabulary(path: str) -> Vocabulary:
    """A BPE tokenizer file with word ends; read once, by the driver."""
    with open(path, encoding="utf-8") as file:
        saved = json.load(file)
    model = saved["model"]
    suffix = model["end_of_word_suffix"]
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in saved["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    pairs = [tuple(p) if isinstance(p, list) else tuple(p.split(" ")) for p in model["merges"]]
    merges = {(ids[a], ids[b]): rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(pairs)}
    characters = byte_characters()
    return Vocabulary(tokens, merges, [ids[c] for c in characters], [ids[c + suffix] for c in characters], special,
                      sufficient_lookahead(pairs, suffix), suffix)


def merged(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """All merges of a short chain, lowest rank first, leftmost first."""
    find = merges.get
    waiting = [*map(find, zip(symbols, symbols[1:]), repeat(NO_MERGE))]
    while waiting:
        best = min(waiting)
        if best == NO_MERGE:
            break
        i = waiting.index(best)
        new = best & ID_MASK
        symbols[i] = new
        del symbols[i + 1], waiting[i]
        if i:
            waiting[i - 1] = find((symbols[i - 1], new), NO_MERGE)
        if i < len(waiting):
            waiting[i] = find((new, symbols[i + 1]), NO_MERGE)
    return symbols


def merged_long(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """The same for a long chain, with a heap."""
    n = len(symbols)
    here, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(merges[pair], i, pair) for i, pair in enumerate(zip(here, here[1:])) if pair in merges]
    heapq.heapify(heap)
    while heap:
        merge, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or (here[i], here[j]) != pair:
            continue
        new = merge & ID_MASK
        here[i], here[j], after[i] = new, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (found := merges.get(key := (new, here[after[i]]))) is not None:
                heapq.heappush(heap, (found, i, key))
        if before[i] >= 0 and (found := merges.get(key := (here[before[i]], new))) is not None:
            heapq.heappush(heap, (found, before[i], key))
    return [i for i in here if i >= 0]


def all_merged(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    return merged(symbols, merges) if len(symbols) < LONG else merged_long(symbols, merges)


def remember(steps: dict, held: bytes, found: tuple) -> None:
    if len(held) < SHORT:
        if len(steps) >= REMEMBERED:
            steps.clear()
        steps[held] = found


class WordTransducer:
    """Bytes of one word in, ids out as soon as they are certain.

    What comes out depends on the bytes held alone, so steps from few bytes are remembered, ``REMEMBERED`` of each kind at most.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, []
        self.fed: dict[bytes, tuple[tuple[int, ...], int]] = {}  # bytes held -> certain ids, the bytes that they take
        self.ended: dict[bytes, tuple[int, ...]] = {}
        self.spelled = dict(enumerate(byte_characters()))
        self.rank: dict[str, int] = {}
        self.crossing: dict[str, int] = {}  # beginning of a token -> lowest rank of a merge that makes such a token
        for merge in vocabulary.merges.values():
            rank, token = merge >> ID_BITS, vocabulary.tokens[merge & ID_MASK]
            body = token.removesuffix(vocabulary.suffix)
            if body == token:
                self.rank[token] = rank
            for k in range(1, len(body)):
                if self.crossing.get(body[:k], NO_MERGE) > rank:
                    self.crossing[body[:k]] = rank
        self.longest = max(map(len, self.crossing), default=0) + 1
        self.width = [len(token.removesuffix(vocabulary.suffix)) for token in vocabulary.tokens]

    def open_from(self, known: str) -> int:
        """The first place where a merge may begin that depends on what follows ``known``; its length if there is none.

        Such a merge crosses the end, or one of lower rank that begins inside it is such a merge. Places are
        visited from the right; ``lowest`` has the lowest rank of such merges by the place where they begin.
        """
        n = first = len(known)
        crossing, made, longest = self.crossing, self.rank, self.longest
        lowest = [NO_MERGE] * (n + 1)
        for start in range(n - 1, -1, -1):
            if first - start > longest:
                break
            here = crossing.get(known[start:], NO_MERGE) if n - start < longest else NO_MERGE
            inside = NO_MERGE
            # A merge that ends at or before ``first`` has none of these inside it.
            for stop in range(first + 1, min(n, start + longest) + 1):
                if lowest[stop - 1] < inside:
                    inside = lowest[stop - 1]
                token = known[start:stop]
                if inside < (rank := made.get(token, NO_MERGE)) < here:
                    here = rank
                if token not in crossing:
                    break
            if here != NO_MERGE:
                lowest[start], first = here, start
        return first

    def feed(self, chunk: bytes) -> list[int]:
        self.held.extend(chunk)
        held = bytes(self.held)
        if (found := self.fed.get(held)) is None:
            found = self.certain(held)
            remember(self.fed, held, found)
        ids, end = found
        del self.held[:end]
        return [*ids]

    def certain(self, held: bytes) -> tuple[tuple[int, ...], int]:
        """The ids that no further byte changes, and how many bytes they take."""
        # The last byte may turn out to be the word's last, which is another symbol.
        known = held[:-1]
        if not known:
            return (), 0
        open_from = max(self.open_from(known.decode("latin-1").translate(self.spelled)), len(known) - self.vocabulary.lookahead)
        if open_from <= 0:
            return (), 0
        inner, ids, end = self.vocabulary.inner, [], 0
        for token in all_merged([inner[b] for b in known], self.vocabulary.merges):
            if end >= open_from:
                break
            ids.append(token)
            end += self.width[token]
        return tuple(ids), end

    def finish(self) -> list[int]:
        held = bytes(self.held)
        if (ids := self.ended.get(held)) is None:
            inner = self.vocabulary.inner
            symbols = [*[inner[b] for b in held[:-1]], self.vocabulary.last[held[-1]]] if held else []
            ids = tuple(all_merged(symbols, self.vocabulary.merges))
            remember(self.ended, held, ids)
        self.held = []
        return [*ids]


class Encoder(dict):
    """Words to packed ids; words seen lately are remembered, ``REMEMBERED`` at most."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.transducer = WordTransducer(vocabulary)
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        self.cut = regex.compile(rf"[{WHITE}]")

    def __missing__(self, word: str) -> bytes:
        data = word.encode()
        packed = b"".join(map(packed_ids, self.stream(data)))
        if len(data) < SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed

    def stream(self, data: bytes) -> Iterator[list[int]]:
        # Short steps first; in a long word they grow, so that what is held is not looked through for every few bytes.
        start, step = 0, STEP
        while len(data) - start > step:
            yield self.transducer.feed(data[start:start + step])
            start, step = start + step, min(2 * step, 4096)
        self.transducer.held.extend(data[start:])
        yield self.transducer.finish()

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text, piece by piece."""
        start = 0
        while start < len(text):
            stop = len(text)
            if stop - start > PIECE and (found := self.cut.search(text, start + PIECE)):
                stop = found.start()
            piece = text[start:stop]
            start = stop
            # Special strings stand at odd places.
            for i, part in enumerate(self.special.split(piece)):
                if i % 2:
                    yield packed_ids([self.vocabulary.special[part]])
                elif part:
                    yield b"".join(map(self.__getitem__, self.words.findall(normalised(part))))


def packed_ids(ids: list[int]) -> bytes:
    """Unsigned 32-bit numbers, lowest byte first."""
    return struct.pack(f"<{len(ids)}I", *ids)


def normalised(text: str) -> str:
    """Composed and lower-cased, each character by itself. White space separates words only and stays."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Decoder:
    """Ids in, text out; an unfinished character waits for its last byte."""

    def __init__(self, pieces: list[bytes], glue: bytes = b""):
        self.pieces, self.glue, self.begun = pieces, glue, False
        self.text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        data = self.glue.join(map(self.pieces.__getitem__, ids))
        if not data:
            return ""
        if self.begun:
            data = self.glue + data
        self.begun = True
        return self.text.decode(data)

    def finish(self) -> str:
        rest = self.text.decode(b"", True)
        self.text.reset()
        self.begun = False
        return rest


def token_decoder(vocabulary: Vocabulary) -> Decoder:
    """Tokens as the vocabulary spells them, one blank between them."""
    return Decoder([t.encode() for t in vocabulary.tokens], b" ")


def text_decoder(vocabulary: Vocabulary) -> Decoder:
    """The text's bytes; a word end becomes a blank."""
    back = {c: b for b, c in enumerate(byte_characters())}

    def plain(token: str) -> bytes:
        if token in vocabulary.special:
            return token.encode()
        body = token.removesuffix(vocabulary.suffix)
        return bytes(back[c] for c in body) + (b" " if body != token else b"")

    return Decoder([plain(t) for t in vocabulary.tokens])


def _id_kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shared.value))
        for batch in batches:
            ids = [np.frombuffer(b"".join(encoder.encode(t.as_py())), "<u4").astype("int32") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(run, f"doc_id {_id_kind(docs)}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` from ``ids``; null ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(read_vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = text_decoder(Vocabulary(**shared.value))
        for batch in batches:
            texts = [decoder.feed(ids.as_py() or []) + decoder.finish() for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_id_kind(encoded)}, text string")


def round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: token count, digest of the ids, digest of the decoded tokens.

    Ids go to the digest and to the decoder piece by piece; with ``keep_ids`` they come out as ``ids`` as well.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**shared.value)
        encoder, decoder = Encoder(vocabulary), token_decoder(vocabulary)
        for batch in batches:
            counts, ids_digests, text_digests, kept = [], [], [], []
            for text in batch.column("text"):
                n, ids_digest, text_digest, own = 0, hashlib.sha256(), hashlib.sha256(), []
                for packed in encoder.encode(text.as_py()):
                    n += len(packed) // 4
                    ids_digest.update(packed)
                    if keep_ids:
                        own.append(packed)
                    text_digest.update(decoder.feed(np.frombuffer(packed, "<u4").tolist()).encode())
                text_digest.update(decoder.finish().encode())
                counts.append(n)
                ids_digests.append(ids_digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
                kept.append(np.frombuffer(b"".join(own), "<u4").astype(np.int32))
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                       "ids_sha256": pa.array(ids_digests, pa.string()), "decoded_sha256": pa.array(text_digests, pa.string())}
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    layout = f"doc_id {_id_kind(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(run, layout)
