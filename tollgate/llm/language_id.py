"""Language identification by nearest centroid.

A text is a vector of hashed character 1- to 3-grams of its lower-cased letters, weighted by TF-IDF
(log of the count, inverse document frequency among all training texts) and scaled to length 1.
Each language has several centroids, found by spherical k-means over all training texts. The nearest centroid by
cosine names the language; a text too far from all centroids of that language is rejected. Short texts are farther off than
long ones, so a language has a limit per length class. It lies under what the farthest percent reach among all
labelled texts that are not held out and a cut of each length from every one of them, a little under for long texts and far under
for short ones; the fewer there are, the lower it lies.
Under ``EDGES[0]`` letters and gaps nothing but letters is asked for.

Every labelled text that is not held out enters the document frequencies, the centroids and the limits. A bounded
sample (``sample`` texts per language, by hash of the id and the text) only says where k-means starts. The prediction
covers all rows and whole texts and uses the text alone.

Defined cases: a null text, or one without letters, is ``und`` with score 0 and rejected; texts with a null
``lang`` are not learned from; a null id is not held out; repeated rows are predicted each; without any
training text every text is ``und``; an empty table gives no rows. ``identify`` keeps all columns of its input.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import stored

DIMENSIONS = 4096
SAMPLE = 600
CENTROIDS = 4
ROUNDS = 10
#: Most rounds of k-means over all texts, from the centres found in the sample; it ends where no centre moves.
PASSES = 3
#: Weights are added up as whole numbers of this many to 1, so that the sums do not depend on the order of the texts.
FINE = 1 << 20
#: Least letters and gaps of the length classes.
EDGES = [4, *[12 * 2**k for k in range(12)]]
#: Per class the share of the farthest percent's similarity that is the limit, times n / (n + FEW) for n texts and cuts.
#: Short texts on other matters than the learned ones reach half of it or less; below 96 letters some foreign texts pass therefore.
SLACK = [0.0, 0.4, 0.4, 0.4, 0.7, 0.7, *[0.85] * 8]
FEW = 20
FARTHEST = 0.01
#: Similarities are counted in steps of this size.
STEP = 0.001
UNKNOWN = "und"


class Letters:
    """Letter test by code point, filled in as code points are met."""

    def __init__(self):
        self.known = np.full(sys.maxunicode + 1, -1, np.int8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        flags = self.known[codes]
        if (flags < 0).any():
            for code in np.unique(codes[flags < 0]).tolist():
                self.known[code] = unicodedata.category(chr(code))[0] == "L"
            flags = self.known[codes]
        return flags == 1


def gram_counts(text: str, letters: Letters) -> np.ndarray | None:
    """Counts of hashed 1-, 2- and 3-grams; None without a letter. Runs of other characters are one gap."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = letters.of(codes)
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, 32)
    codes = np.concatenate(([32], codes, [32]))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = codes[keep]
    mixed = codes * 0x9E3779B1
    two = mixed[:-1] * 31 + codes[1:] * 0x85EBCA6B + 1
    three = two[:-1] * 131 + codes[2:] * 0xC2B2AE35 + 2
    grams = np.concatenate((mixed, two, three))
    return np.bincount(((grams ^ (grams >> 15)) >> 3) % DIMENSIONS, minlength=DIMENSIONS).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1."""
    vectors = np.log1p(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-12)


def clustered(vectors: np.ndarray, centroids: int = CENTROIDS) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, each further one the text farthest from all so far."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < min(centroids, len(vectors)):
        nearest = (vectors @ np.array(centres).T).max(axis=1)
        centres.append(vectors[int(nearest.argmin())])
    found = np.array(centres)
    for _ in range(ROUNDS):
        found = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        owner = (vectors @ found.T).argmax(axis=1)
        found = np.array([vectors[owner == k].mean(axis=0) if (owner == k).any() else found[k] for k in range(len(found))])
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


@dataclass
class LanguageModel:
    """Inverse document frequencies, all centroids, and per language its name and a rejection limit per length class."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    languages: list[str]
    limits: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def column_sums(known: DataFrame, languages: list[str], lines: int,
                enter: Callable[[np.ndarray, int, np.ndarray], None]) -> np.ndarray:
    """A table of ``lines`` x DIMENSIONS whole numbers, added up over all texts of ``known``.

    ``enter`` gets a task's table, the number of a language and the gram counts of some of its texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, number = Letters(), {name: i for i, name in enumerate(languages)}
        seen = np.zeros((lines, DIMENSIONS), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found: dict[int, list[np.ndarray]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text")):
                    if (counts := gram_counts(text.as_py(), letters)) is not None:
                        found.setdefault(number[lang], []).append(counts)
                for language, rows in found.items():
                    enter(seen, language, np.array(rows))
        line, column = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(line, pa.int64()), pa.array(column, pa.int64()), pa.array(seen[line, column], pa.int64())],
                                         ["line", "column", "n"])

    table = known.select("lang", "text").mapInArrow(run, "line bigint, column bigint, n bigint")
    # At most as many rows as the table has places.
    sums = table.groupBy("line", "column").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((lines, DIMENSIONS), np.int64)
    out[sums["line"].to_numpy(np.int64), sums["column"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def moved(known: DataFrame, model: LanguageModel) -> np.ndarray:
    """The centroids after a round of spherical k-means over all texts of ``known``."""
    shared = known.sparkSession.sparkContext.broadcast(vars(model))

    def enter(sums: np.ndarray, language: int, counts: np.ndarray) -> None:
        learned = LanguageModel(**shared.value)
        own = np.flatnonzero(learned.owner == language)
        rows = weighted(counts, learned.idf)
        nearest = own[(rows @ learned.centroids[own].T).argmax(axis=1)]
        whole_numbers = np.rint(rows * FINE).astype(np.int64)
        for centre in np.unique(nearest):
            sums[centre] += whole_numbers[nearest == centre].sum(axis=0)

    sums = column_sums(known, model.languages, len(model.centroids), enter) / FINE
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(length > 0, sums / np.maximum(length, 1e-12), model.centroids).astype(np.float32)


def fit(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from all labelled texts that are not held out; ``sample`` texts per language give k-means its start."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # One row per language, in one file: its size shows that it can be broadcast, and no text is shuffled.
    counts = stored(known.groupBy("lang").count().repartition(1), "language-counts")
    # Drawn by id and text, so that rows whose ids are missing or repeated have draws of their own; copies are drawn as one.
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)) / (1 << 30)
    narrow = known.select("lang", "text", draw.alias("_draw")).join(counts, "lang")
    # 1.25: so that nearly every draw holds the sample; the group then keeps the smallest draws.
    drawn = narrow.where(F.col("_draw") * F.col("count") < 1.25 * sample + 20).select("lang", "text", "_draw").distinct()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            rows = [(lang.as_py(), draw.as_py(), gram_counts(text.as_py(), letters))
                    for lang, draw, text in zip(batch.column("lang"), batch.column("draw"), batch.column("text"))]
            rows = [(lang, draw, found.tobytes()) for lang, draw, found in rows if found is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["lang", "draw", "counts"])

    layout = "lang string, draw double, counts binary"
    taken = stored(drawn.select("lang", F.col("_draw").alias("draw"), "text").mapInArrow(vectors, layout), "language-sample")

    def of(group: pd.DataFrame) -> np.ndarray:
        chosen = group.sort_values(["draw", "counts"]).head(sample)["counts"]
        return np.array([np.frombuffer(c, np.float32) for c in chosen])

    def texts_with(seen: np.ndarray, language: int, counts: np.ndarray) -> None:
        seen[language] += (counts > 0).sum(axis=0)
        seen[-1, language % DIMENSIONS] += len(counts)

    texts = {r["lang"]: r["count"] for r in counts.collect()}
    # Per language and gram the texts that have it; the last line adds up to the texts with letters.
    frequencies = column_sums(known, sorted(texts), len(texts) + 1, texts_with)
    n, df = int(frequencies[-1].sum()), frequencies[:-1].sum(axis=0)
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        rows = weighted(of(group), idf)
        found = clustered(rows)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "n": [len(found)], "centroids": [found.astype(np.float32).tobytes()]})

    fitted = taken.groupBy("lang").applyInPandas(centroids, "lang string, n bigint, centroids binary").toPandas()
    starts = {lang: np.frombuffer(c, np.float32).reshape(-1, DIMENSIONS) for lang, c in zip(fitted["lang"], fitted["centroids"])}
    for lang, frequency in zip(sorted(texts), frequencies):
        if lang not in starts and frequency.any():  # the sample drew nothing with a letter
            starts[lang] = weighted(frequency[None].astype(np.float32), idf)
    languages = sorted(starts)
    model = LanguageModel(
        idf, np.concatenate([starts[lang] for lang in languages]) if languages else np.zeros((0, DIMENSIONS), np.float32),
        np.repeat(np.arange(len(languages)), [len(starts[lang]) for lang in languages]), languages,
        np.zeros((len(languages), len(EDGES) + 1)))
    learned = known.where(F.col("lang").isin(languages)) if languages else known
    for _ in range(PASSES if languages else 0):
        before, model.centroids = model.centroids, moved(learned, model)
        if np.array_equal(before, model.centroids):
            break
    model.limits = rejection_limits(learned, model)
    return model


def length_class(counts: np.ndarray) -> np.ndarray:
    """Length class of each row of gram counts; a text of n letters and gaps has 3 n + 3 grams."""
    return np.searchsorted(EDGES, (counts.sum(axis=-1, dtype=np.float64) - 3) / 3, side="right")


def cuts(text: str) -> list[str]:
    """The text and a cut of it for every length class that it is longer than."""
    found = [text]
    for k, edge in enumerate(EDGES):
        size = edge + edge // 5
        if size < len(text):
            start = (len(text) * 7919 + k * 104729) % (len(text) - size + 1)
            found.append(text[start:start + size])
    return found


def rejection_limits(known: DataFrame, model: LanguageModel) -> np.ndarray:
    """Limits per language and length class, from the similarities of all texts of ``known``, and of a cut of each
    for every length class under its own, to their own language.
    """
    if not model.languages:
        return model.limits
    shared = known.sparkSession.sparkContext.broadcast(vars(model))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, learned = Letters(), LanguageModel(**shared.value)
        number = {name: i for i, name in enumerate(learned.languages)}
        seen = np.zeros((len(number), len(EDGES) + 1, round(1 / STEP) + 1), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in number:
                    continue
                counts = [c for c in (gram_counts(t, letters) for t in cuts(text.as_py())) if c is not None]
                if counts:
                    rows = np.array(counts)
                    near = (weighted(rows, learned.idf) @ learned.centroids[learned.owner == number[lang]].T).max(axis=1)
                    np.add.at(seen, (number[lang], length_class(rows), (np.clip(near, 0, 1) / STEP).astype(int)), 1)
        at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in at], pa.array(seen[at], pa.int64())],
                                         ["language", "class", "step", "n"])

    found = known.select("lang", "text").mapInArrow(counted, "language bigint, class bigint, step bigint, n bigint")
    # At most a row per language, class and step.
    rows = found.groupBy("language", "class", "step").agg(F.sum("n").alias("n")).toPandas().sort_values("step")

    def farthest(group: pd.DataFrame) -> float:
        return STEP * float(group["step"].to_numpy()[int((group["n"].cumsum() > FARTHEST * group["n"].sum()).to_numpy().argmax())])

    # The farthest of all languages bounds those of which few texts are known.
    of_all = {k: farthest(group) for k, group in rows.groupby("class")}
    limits = np.zeros_like(model.limits)
    for (language, k), group in rows.groupby(["language", "class"]):
        total = group["n"].sum()
        limits[int(language), int(k)] = SLACK[int(k)] * min(farthest(group), of_all[k]) * total / (total + FEW)
    return limits


def _predicted(texts: list[str], model: LanguageModel, letters: Letters) -> list[tuple[str, float, bool]]:
    counts = [gram_counts(t, letters) for t in texts]
    present = [i for i, c in enumerate(counts) if c is not None]
    out = [(UNKNOWN, 0.0, True)] * len(texts)
    if present and len(model.languages):
        rows = np.array([counts[i] for i in present])
        similar = weighted(rows, model.idf) @ model.centroids.T
        best, of_length = similar.argmax(axis=1), length_class(rows)
        for row, i in enumerate(present):
            language = int(model.owner[best[row]])
            score = min(max(float(similar[row, best[row]]), 0.0), 1.0)
            out[i] = (model.languages[language], score if math.isfinite(score) else 0.0, score < model.limits[language, of_length[row]])
    return out


def predict(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = [f"k{i}" for i in range(len(keep))]
    # A text that is kept crosses to Python once.
    read = names[keep.index("text")] if "text" in keep else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, learned = Letters(), LanguageModel(**shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = _predicted([t or "" for t in part.column(read).to_pylist()], learned, letters)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                    [*names, "lang_pred", "score", "rejected"])

    kept = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], *([] if read in names else [F.col("text").alias(read)]))
    layout = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names)],
                        "lang_pred string, score double, rejected boolean"])
    out = kept.mapInArrow(run, layout)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "lang_pred", "score", "rejected")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document."""
    found = predict(docs, fit(docs, sample), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


#: Columns that a prediction adds.
ADDED = ("lang_pred", "score", "rejected")


def accepted(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    if any(c.lower() in ADDED for c in docs.columns):
        return _accepted_beside(docs, sample)
    return predict(docs, fit(docs, sample), docs.columns).where(~F.col("rejected")).select(*docs.columns)


def _accepted_beside(docs: DataFrame, sample: int) -> DataFrame:
    """The same for a table that has columns of these names itself."""
    longer = "_" * max(map(len, docs.columns))  # no column has a name that begins with it and goes on
    renamed = docs.select(*[F.col(c).alias(longer + c if c.lower() in ADDED else c) for c in docs.columns])
    return accepted(renamed, sample).toDF(*docs.columns)
