"""SentencePiece encoding by merge rounds over flat arrays, and decoding.

The words of many texts are laid out as one array of symbols, cut into segments where no piece of the vocabulary
reaches across. A round finds the best pair of every segment (a segmented minimum of the pair ranks), merges all places of it at
once, the leftmost first where two overlap, and closes the gaps. Segments without a pair leave the array; the rounds end
when none is left. Where a merge opens a pair that is better than the one merged, the later places of that
segment wait for the next round, so every vocabulary gives exactly the order of one merge at a time.

Short words that were encoded lately are remembered, ``REMEMBERED`` at most. A task holds one Arrow batch, the remembered words and
the words and arrays of about ``GROUP_CHARS`` characters of text, or of one longer text. The vocabulary is broadcast; its size is that of the model file.

Defined cases: null is the empty text; an empty text has no ids and decodes to the empty text; very long texts and unbroken words are
encoded whole; repeated rows are encoded each; an empty table gives no rows; columns other than doc_id and text (of ids: doc_id and
ids) are left out, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tollgate.llm.common import whole

MARK = "▁"
REMEMBERED = 1 << 16
#: Longer words are not remembered.
LONG_WORD = 64
#: Texts are cut, and new words merged, in groups of about so many characters; what is longer is a group of its own.
GROUP_CHARS = 1 << 18
NO_PAIR = np.iinfo(np.int32).max
FOREIGN = -1


class Vocabulary:
    """Pieces, pair ranks and bytes of a model of the BPE kind with byte fallback and a dummy prefix."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.control = [model.is_control(i) for i in range(size)]
        self.byte = [model.is_byte(i) for i in range(size)]
        self.unknown = model.unk_id()
        usable = [i for i in range(size) if not (
            self.control[i] or self.byte[i] or model.is_unknown(i) or model.is_unused(i))]
        names = {i: model.id_to_piece(i) for i in usable}
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(size):
            if self.byte[i]:
                self.byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        if not all(self.byte[int(i)] for i in self.byte_ids):
            raise ValueError(f"{model_path}: a vocabulary with all 256 byte pieces is needed")
        self.surface = [
            b"" if self.control[i] else bytes([int(model.id_to_piece(i)[3:5], 16)]) if self.byte[i]
            else names[i].replace(MARK, " ").encode() if i in names else " ⁇ ".encode() for i in range(size)]
        self.leads = [i in names and names[i].startswith(MARK) for i in range(size)]

        # Equal scores are one rank: the leftmost of them goes first.
        scores = sorted({model.get_score(i) for i in usable}, reverse=True)
        rank = {score: place for place, score in enumerate(scores)}
        symbols = {name: i for i, name in names.items()}
        for char in sorted({c for name in names.values() for c in name}):
            symbols.setdefault(char, size + len(symbols))  # a character inside pieces that is no piece itself
        pairs = {}
        for i, name in names.items():
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank[model.get_score(i)], i)
        self.size = size
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks, self.merged = np.array([pairs[k] for k in sorted(pairs)], np.int32).reshape(-1, 2).T.copy()
        self.chars = {ord(name): i for name, i in symbols.items() if len(name) == 1}
        joined = {name[k:k + 2] for name in names.values() for k in range(len(name) - 1)}
        self.joined = np.array(sorted(ord(a) << 21 | ord(b) for a, b in joined), np.int64)
        # Words may be cut apart before a run of marks and around line feeds, if no piece reaches across.
        apart = not any(a != MARK and b == MARK for a, b in joined) and not any("\n" in pair for pair in joined)
        self.words = rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if apart else r"(?s).+"


class Places:
    """Finds keys in an array by open addressing, all asked keys at once."""

    FACTOR, FREE = np.uint64(0x9E3779B97F4A7C15), -1

    def __init__(self, keys: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.places = np.full(1 << bits, self.FREE, np.int64), np.zeros(1 << bits, np.int64)
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            first = np.zeros(len(waiting), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.keys[slot] == self.FREE
            self.keys[slot[first]], self.places[slot[first]] = keys[waiting[first]], waiting[first]
            waiting, slot = waiting[~first], (slot[~first] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of every key, and whether it is there."""
        slot = self._slot(wanted)
        met = self.keys[slot]
        known = met == wanted
        going = np.flatnonzero(~known & (met != self.FREE))
        while len(going):
            slot[going] = (slot[going] + 1) & self.last
            met = self.keys[slot[going]]
            known[going] = found = met == wanted[going]
            going = going[~found & (met != self.FREE)]
        return self.places[slot], known


class Merger:
    """Encodes words by rounds over all of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs, self.joined = Places(vocabulary.keys), Places(vocabulary.joined)
        self.symbol_of = np.full(0x110000, FOREIGN, np.int32)
        self.symbol_of[list(vocabulary.chars)] = list(vocabulary.chars.values())

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        place, known = self.pairs.find(left.astype(np.int64) << 32 | right)
        return np.where(known & (left >= 0) & (right >= 0), self.v.ranks[place], NO_PAIR)

    def pair_symbols(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.v.merged[self.pairs.find(left.astype(np.int64) << 32 | right)[0]]

    def _merges(self, symbol, rank, segment) -> tuple[np.ndarray, np.ndarray]:
        """Places to merge in this round, and the symbols they become."""
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(symbol)])
        marked = (rank == np.repeat(least, sizes)) & (rank != NO_PAIR)
        at = np.flatnonzero(marked)
        # Neighbouring marked places overlap: of each chain every other one, from the left.
        first = np.r_[True, at[1:] != at[:-1] + 1]
        chain = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - chain) % 2 == 0]
        new = self.pair_symbols(symbol[at], symbol[at + 1])
        several = np.flatnonzero(np.r_[False, segment[at[1:]] == segment[at[:-1]]] | np.r_[segment[at[1:]] == segment[at[:-1]], False])
        if len(several):
            place, made = at[several], new[several]
            before, after = place - 1, np.minimum(place + 2, len(symbol) - 1)
            left = symbol[before]
            close = np.r_[False, place[1:] == place[:-1] + 2]
            left[close] = made[:-1][close[1:]]
            better = np.where((before >= 0) & (segment[before] == segment[place]), self.pair_ranks(left, made), NO_PAIR) <= rank[place]
            inside = (place + 2 < len(symbol)) & (segment[after] == segment[place])
            better |= np.where(inside, self.pair_ranks(made, symbol[after]), NO_PAIR) <= rank[place]
            if better.any():
                stop = {}
                for s, p in zip(segment[place[better]].tolist(), place[better].tolist()):
                    stop.setdefault(s, p)
                kept = np.array([p <= stop.get(s, p) for s, p in zip(segment[at].tolist(), at.tolist())])
                at, new = at[kept], new[kept]
        return at, new

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word as 32-bit integers; words are not empty."""
        point = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        word_ends = np.cumsum([len(w) for w in words])
        cut = np.zeros(len(point), bool)
        cut[1:] = ~self.joined.find(point[:-1] << 21 | point[1:])[1]
        cut[0] = True
        cut[word_ends[:-1]] = True
        segment = np.cumsum(cut)
        symbol, place = self.symbol_of[point], np.arange(len(point))
        rank = np.full(len(point), NO_PAIR, np.int32)
        rank[:-1] = np.where(cut[1:], NO_PAIR, self.pair_ranks(symbol[:-1], symbol[1:]))
        done = []
        while True:
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            alive = np.minimum.reduceat(rank, starts) != NO_PAIR
            if not alive.all():
                going = np.repeat(alive, np.diff(np.r_[starts, len(symbol)]))
                done.append((place[~going], symbol[~going]))
                symbol, rank, segment, place = symbol[going], rank[going], segment[going], place[going]
                if not len(symbol):
                    break
            at, new = self._merges(symbol, rank, segment)
            symbol[at] = new
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, rank, segment, place = symbol[keep], rank[keep], segment[keep], place[keep]
            moved = at - np.arange(len(at))
            touched = np.zeros(len(symbol), bool)
            touched[moved] = True
            touched[moved[moved > 0] - 1] = True
            pairs = np.flatnonzero(touched)
            right = np.minimum(pairs + 1, len(symbol) - 1)
            one = (pairs + 1 < len(symbol)) & (segment[pairs] == segment[right])
            rank[pairs] = np.where(one, self.pair_ranks(symbol[pairs], symbol[right]), NO_PAIR)
        place = np.concatenate([p for p, _ in done])
        order = np.argsort(place)
        place, symbol = place[order], np.concatenate([s for _, s in done])[order]
        bounds = np.searchsorted(place, word_ends)
        # Characters without a piece become their bytes.
        bare = np.flatnonzero((symbol < 0) | (symbol >= self.v.size))
        if len(bare):
            encoded = [self.v.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in point[place[bare]].tolist()]
            lengths = np.ones(len(symbol), np.int64)
            lengths[bare] = [len(e) for e in encoded]
            ends = np.cumsum(lengths)
            ids = np.repeat(symbol, lengths)
            for stop, own in zip(ends[bare].tolist(), encoded):
                ids[stop - len(own):stop] = own
            bounds = np.r_[0, ends][bounds]
        else:
            ids = symbol
        packed, stops = ids.astype(np.int32).tobytes(), (4 * bounds).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Ids of whole texts; ``known`` holds the ids (as bytes) of words seen lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.merger = Merger(vocabulary)
        self.known: dict[str, bytes] = {}
        self.words = re.compile(vocabulary.words).findall

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered, in groups of a bounded size."""
        found, group, chars = {}, [], 0
        for i, word in enumerate(words):
            group.append(word)
            chars += len(word)
            if chars >= GROUP_CHARS or i + 1 == len(words):
                found.update(zip(group, self.merger.encode(group)))
                group, chars = [], 0
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.words(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        seen = set().union(*cut)
        new = self._learn(list(seen.difference(self.known)))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {w: self.known[w] for w in seen.intersection(self.known)}
        self.known.update(new)
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32) for words in cut]
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]
        if len(self.known) > REMEMBERED:
            self.known = {}
        return out


class Decoder:
    """Texts of ids. Byte pieces in a row are read as UTF-8, each wrong byte as U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.controls = {i for i, control in enumerate(vocabulary.control) if control}

    def _bytes(self, run: bytes) -> bytes:
        out, i = b"", 0
        while i < len(run):
            for width in (1, 2, 3, 4):
                try:
                    run[i:i + width].decode()
                except UnicodeDecodeError:
                    continue
                out, i = out + run[i:i + width], i + width
                break
            else:
                out, i = out + "�".encode(), i + 1
        return out

    def decode(self, ids: list[int]) -> str:
        lead = next((i for i in ids if not self.v.control[i]), None)
        pieces = b"".join(map(self.v.surface.__getitem__, ids))
        try:
            # A control piece ends a run of bytes, though it has none itself.
            text = pieces.decode() if self.controls.isdisjoint(ids) else None
        except UnicodeDecodeError:
            text = None
        if text is None:
            out, run = [], b""
            for i in ids:
                if self.v.byte[i]:
                    run += self.v.surface[i]
                else:
                    out += [self._bytes(run), self.v.surface[i]]
                    run = b""
            text = b"".join([*out, self._bytes(run)]).decode()
        return text[1:] if lead is not None and self.v.leads[lead] else text


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch in groups, each with the place of its first."""
    first, group, chars = 0, [], 0
    for i, text in enumerate(texts):
        group.append(text.as_py())
        chars += len(group[-1])
        if chars >= GROUP_CHARS or i + 1 == len(texts):
            yield first, group
            first, group, chars = i + 1, [], 0


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, without begin or end ids."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for first, texts in _groups(batch.column("text")):
                found = encoder.encode(texts)
                starts = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids and text of every list of ids; null is the empty list and gives the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            lists = batch.column("ids")
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
            texts = [decoder.decode(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
