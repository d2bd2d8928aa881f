"""A hidden Markov language model, trained with Baum-Welch counts added up over partitions.

Tokens are the words of a text, lower-cased in A-Z, and one end. A unigram model over all training words gives
the base score. The hidden states share its words: a state emits one of ``CLASSES`` word
classes (a hash of the word; the unknown word is a class of its own) and the class emits the word with its
unigram share. So the states' tables have a fixed size, while the word counts, which
grow with the corpus, stay a distributed table that is joined to the texts.

Texts are packed once into blocks of about ``BLOCK_TOKENS`` tokens, each with its own word list;
only word lists and their counts are shuffled, and every word is sent once a block however often it occurs.
A training round reads all blocks, runs the scaled forward and backward recursions over all
training texts, and adds up expected counts by class. Scoring runs the scaled forward recursion over each whole text:
its result is the exact likelihood under the model.

Defined cases: a null text is the empty text, which is one end; a null id counts as a training text and is not held out;
repeated rows count as often as they occur; without training texts every word is unknown; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import stored, whole

STATES = 6
CLASSES = 16_384
ROUNDS = 4
BLOCK_TOKENS = 1_500_000
SEED = 7
#: Expected counts added to every class and transition of a state.
CLASS_PRIOR = 0.1
MOVE_PRIOR = 0.1
#: The end of a text; no word is empty.
END = b""


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 1, F.lit(False))


BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())),
    ("tokens", pa.binary()), ("classes", pa.binary()), ("words", pa.list_(pa.binary())), ("n_train", pa.list_(pa.int64())),
])
BLOCK_LAYOUT = ("block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, tokens binary, "
                "classes binary, words array<binary>, n_train array<bigint>")


def squeezed(numbers: np.ndarray) -> bytes:
    """Small non-negative numbers in few bytes: their four byte planes one after the other, deflated."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def packed(docs: DataFrame) -> DataFrame:
    """Blocks of texts as numbers into the block's own word list, with the training count of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, held, lengths, tokens, size = [], [], [], [], 0
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__

        def block() -> pa.RecordBatch:
            flat = np.concatenate(tokens)
            train = np.repeat(~np.array(held), lengths)
            counts = np.bincount(flat[train], minlength=len(numbers))
            classes = np.array([zlib.crc32(w) % CLASSES for w in numbers], "<u2")
            values = [[number], [ids], [held], [lengths], [squeezed(flat)], [classes.tobytes()], [list(numbers)], [counts.tolist()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, BLOCKS)], schema=BLOCKS)

        for batch in batches:
            for doc_id, out, text in zip(batch.column("doc_id"), batch.column("held"), batch.column("text")):
                found = text.as_py().encode().lower().split()
                found.append(END)
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                lengths.append(len(found))
                tokens.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                size += len(found)
                if size >= BLOCK_TOKENS:
                    yield block()
                    number += 1
                    ids, held, lengths, tokens, size = [], [], [], [], 0
                    numbers.clear()
        if size:
            yield block()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), whole("text").alias("text"))
    return texts.mapInArrow(run, BLOCK_LAYOUT)


@dataclass
class Model:
    """Start, moves and class emissions of the states (the last class is the unknown word), and each class's unigram share."""

    start: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray
    share: np.ndarray
    unknown: float


def _layout_by_step(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts by falling length; the order of all tokens by step, and how many texts each step has."""
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
    steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(sorted_lengths) - sorted_lengths, sorted_lengths)
    tokens = np.repeat(starts, sorted_lengths) + steps
    by_step = np.argsort(steps, kind="stable")
    return order, tokens[by_step], np.bincount(steps)


def _forward(model: Model, seen: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward variables and their scales, tokens in order of steps. ``seen``: emissions of each token by state."""
    scales = np.empty(len(seen), np.float32)
    at = 0
    alpha = None
    for n in active.tolist():
        here = seen[at:at + n]
        here *= model.start if alpha is None else alpha[:n] @ model.moves
        scale = here.sum(axis=1)
        here /= scale[:, None]
        scales[at:at + n] = scale
        alpha = here
        at += n
    return seen, scales


def _expected(model: Model, classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected emissions (by class), moves and starts of some texts."""
    _, tokens, active = _layout_by_step(lengths)
    symbols = classes[tokens]
    emitted = model.emissions.T[symbols]
    alpha, scales = _forward(model, emitted.copy(), active)
    moves = np.zeros((STATES, STATES))
    stops = np.cumsum(active).tolist()
    back = np.ascontiguousarray(model.moves.T)
    beta = None
    for step in range(len(active) - 1, -1, -1):
        n, stop = int(active[step]), stops[step]
        here = np.ones((n, STATES), np.float32)  # a text's last token has nothing after it
        if beta is not None:
            later = len(beta)
            message = beta * emitted[stop:stop + later]
            message /= scales[stop:stop + later, None]
            moves += alpha[stop - n:stop - n + later].T @ message
            here[:later] = message @ back
            alpha[stop:stop + later] *= beta  # from here on the posterior of that step
        beta = here
    if beta is not None:
        alpha[:len(beta)] *= beta
    emissions = np.stack([np.bincount(symbols, weights=alpha[:, s], minlength=CLASSES) for s in range(STATES)])
    return emissions, moves * model.moves, alpha[:int(active[0])].sum(axis=0) if len(active) else np.zeros(STATES)


def _round(blocks: DataFrame, model: Model) -> Model:
    """One Baum-Welch round: expected counts of every block, added up by class."""
    shared = blocks.sparkSession.sparkContext.broadcast(vars(model))
    names = [f"s{i}" for i in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = Model(**shared.value)
        total = np.zeros((CLASSES + STATES + 1, STATES))
        for batch in batches:
            for row in batch.to_pylist():
                lengths, train = np.array(row["lengths"]), ~np.array(row["held"])
                classes = np.frombuffer(row["classes"], "<u2")[unsqueezed(row["tokens"])]
                chosen = classes[np.repeat(train, lengths)]
                if len(chosen):
                    emissions, moves, starts = _expected(current, chosen, lengths[train])
                    total[:CLASSES] += emissions.T
                    total[CLASSES:CLASSES + STATES] += moves
                    total[-1] += starts
        used = np.flatnonzero(total.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array(total[used, i]) for i in range(STATES)]], ["key", *names])

    layout = "key bigint, " + ", ".join(f"{n} double" for n in names)
    counts = blocks.select("held", "lengths", "tokens", "classes").mapInArrow(run, layout)
    added = counts.groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # classes and states, a fixed number
    total = np.zeros((CLASSES + STATES + 1, STATES))
    total[added["key"].to_numpy(np.int64)] = added[names].to_numpy()
    present = model.share[:CLASSES] > 0
    emissions = np.where(present[:, None], total[:CLASSES] + CLASS_PRIOR, 0.0).T
    return _model(total[-1] + MOVE_PRIOR, total[CLASSES:CLASSES + STATES] + MOVE_PRIOR, emissions, model.share, model.unknown)


def _model(start: np.ndarray, moves: np.ndarray, emissions: np.ndarray, share: np.ndarray, unknown: float) -> Model:
    """Scale rows to 1; every state gives the unknown word its unigram share."""
    known = emissions[:, :CLASSES] / np.maximum(emissions[:, :CLASSES].sum(axis=1, keepdims=True), 1e-300) * (1 - unknown)
    full = np.concatenate((known, np.full((STATES, 1), unknown)), axis=1)
    return Model((start / start.sum()).astype(np.float32), (moves / moves.sum(axis=1, keepdims=True)).astype(np.float32),
                 full.astype(np.float32), share, unknown)


def train(blocks: DataFrame, counts: DataFrame, n: int, v: int, rounds: int = ROUNDS) -> Model:
    """Fit the states over all training texts; ``counts`` has word and c."""
    classes = counts.groupBy(F.pmod(F.crc32("word"), F.lit(CLASSES)).alias("class")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()  # a fixed number of classes
    whole_mass = n + 0.5 * (v + 1)
    share = np.zeros(CLASSES + 1)
    share[classes["class"].to_numpy(np.int64)] = (classes["c"].to_numpy(float) + 0.5 * classes["v"].to_numpy(float)) / whole_mass
    share[CLASSES] = unknown = 0.5 / whole_mass
    noise = np.random.default_rng(SEED)
    emissions = share[None, :CLASSES] * noise.gamma(2.0, 0.5, (STATES, CLASSES))
    moves = np.full((STATES, STATES), 0.05 / (STATES - 1)) + np.eye(STATES) * (0.95 - 0.05 / (STATES - 1))
    model = _model(np.ones(STATES), moves, emissions, share, unknown)
    if n:
        for _ in range(rounds):
            model = _round(blocks, model)
    return model


def log_likelihoods(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of each text's probability as a sequence of classes."""
    order, tokens, active = _layout_by_step(lengths)
    symbols = classes[tokens]
    _, scales = _forward(model, model.emissions.T[symbols], active)
    text = np.concatenate([np.arange(n) for n in active.tolist()]) if len(active) else np.zeros(0, np.int64)
    sums = np.bincount(text, weights=np.log(scales.astype(np.float64)), minlength=len(lengths))
    out = np.empty(len(lengths))
    out[order] = sums
    return out


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text, logs to base 10."""
    blocks = stored(packed(docs), "blocks")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "n_train")).alias("at", "w"))
    listed = listed.select("block", "at", F.col("w.words").alias("word"), F.col("w.n_train").alias("n_train"))
    counts = stored(listed.where("n_train > 0").groupBy("word").agg(F.sum("n_train").alias("c")), "word-counts")
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = facts["n"], facts["v"]
    model = train(blocks, counts, n, v, rounds)
    # Each block gets the counts of its own words: a list as long as the block's word list.
    known = listed.select("block", "at", "word").join(counts, "word").groupBy("block").agg(
        F.collect_list(F.struct("at", "c")).alias("known"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        share = np.log10(np.maximum(model.share, 1e-300))
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                lengths = np.array(row.column("lengths")[0].as_py())
                tokens = unsqueezed(row.column("tokens")[0].as_py())
                word_classes = np.frombuffer(row.column("classes")[0].as_py(), "<u2").astype(np.int32)
                c = np.zeros(len(word_classes))
                found = row.column("known")[0].values
                if found is not None:
                    c[found.field("at").to_numpy()] = found.field("c").to_numpy()
                word_classes[c == 0] = CLASSES
                base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
                text = np.repeat(np.arange(len(lengths)), lengths)
                base_score = np.bincount(text, weights=base[tokens], minlength=len(lengths))
                # Inside its class a word has its unigram share.
                within = np.bincount(text, weights=(base - share[word_classes])[tokens], minlength=len(lengths))
                total = log_likelihoods(model, word_classes[tokens], lengths) / np.log(10) + within
                n_known = np.bincount(text, weights=(c > 0)[tokens], minlength=len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row.column("doc_ids")[0].as_py(), pa.int64()), pa.array(row.column("held")[0].as_py(), pa.bool_()),
                     pa.array(lengths, pa.int64()), pa.array(n_known.astype(np.int64)), pa.array(np.full(len(lengths), n, np.int64)),
                     pa.array(base_score), pa.array(total)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    layout = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    joined = blocks.select("block", "doc_ids", "held", "lengths", "tokens", "classes").join(known, "block", "left")
    return joined.select("doc_ids", "held", "lengths", "tokens", "classes", "known").mapInArrow(run, layout)
