"""Quality rules: text statistics, base limits, and robust outliers per language and source.

A text passes when it meets the base limits and its statistic vector is not an outlier among
the texts of its language and source. Location and scatter of each such cell are
minimum-covariance-determinant estimates: from several robust starts, concentration
steps keep the rows nearest to the current estimate and estimate anew, and the start whose
scatter ends with the smallest determinant wins. All rows take part in every step.

Estimates are made at three levels: language and source, language, all texts. A text is judged by the
narrowest that rests on ``min_rows`` texts or more, or else by the one of all texts, whatever their number: the
floors of the scatter keep it regular, so every text that passes the base limits has a distance.

Defined cases: null or empty texts have no words and fail the base limits; a null language
or source is one of its own. Repeated rows count as often as they occur. Very long texts are read whole. An empty table
gives no rows. Other columns are left out by ``text_statistics``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import SPACE, let, stored, whole, word_runs, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Transformed statistics: log words, log mean word length, and logs of symbol, line and repeat shares.
VECTOR = ["x0", "x1", "x2", "x3", "x4"]
P = len(VECTOR)
#: Least standard deviation per statistic: constant statistics must not make a scatter singular.
FLOOR = [0.5, 0.1, 0.5, 0.35, 0.35]
#: Share of a cell's rows that an estimate rests on, and the factor that makes the scatter of
#: that share of a normal sample consistent: share / P(chi2 with P + 2 <= q), q the chi2 quantile of the share.
SHARE = 0.75
CONSISTENCY = 1.412
#: Squared Mahalanobis distance beyond which a text is rejected: the chi2 quantile with P degrees that 1 in 100,000 exceeds.
CUTOFF = 30.86
STARTS = 3
STEPS = 3
MIN_ROWS = 50


def repeated_words(tokens: Column) -> Column:
    """Words in windows of eight that occur twice or more in the text, the first one included.

    Windows that repeat start at p1 < p2 < ...; each covers the words up to the next start, eight at most.
    """
    def covered(starts: Column) -> Column:
        gaps = F.zip_with(
            starts, F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.lit(2**31 - 1))),
            lambda here, after: F.least(after - here, F.lit(WINDOW)).cast("bigint"),
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    def starts_of(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(pairs, lambda s: F.filter(s, lambda x, k: (
            (k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    return let(word_runs(tokens, F.size(tokens), WINDOW), lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")
    ).otherwise(let(starts_of(hashes), covered)))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every whole text."""
    text = whole("text")
    with_word = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("r")))
    facts = docs.select(
        "doc_id", "lang", "source", counted.alias("_w"),
        F.char_length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
    )
    n, repeated = F.col("_w.n"), F.col("_w.r")
    return facts.select(
        "doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated.alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
    )


def _vectors(facts: DataFrame) -> DataFrame:
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return facts.withColumns({
        "x0": F.log(n), "x1": F.log(chars / n), "x2": F.log1p(100 * F.col("n_symbols") / chars),
        "x3": F.log1p(100 * F.col("n_dup_lines") / n), "x4": F.log1p(10 * F.col("n_repeat_words") / n),
    })


def _cells(rows: DataFrame, min_rows: int) -> DataFrame:
    """Add ``cell``, the estimate that judges a text, and ``feeds``, the estimates that it takes part in.

    The estimate of a language is made where a source of it is small, the one of all texts where a language is.
    """
    fine, coarse = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang", F.lit("*").alias("rest")))
    everything = F.lit('{"all":"*"}')
    counts = _small(rows.groupBy(fine.alias("_fine"), coarse.alias("_coarse")).agg(
        F.count_if(~F.col("base_failed")).alias("_n")), "cell-counts")
    languages = _small(counts.groupBy("_coarse").agg(
        F.sum("_n").alias("_all"), F.max(F.col("_n") < min_rows).alias("_parted")), "language-counts")
    rare_languages = languages.agg(F.max(F.col("_all") < min_rows)).first()[0]
    enough, spoken = F.col("_n") >= min_rows, F.col("_all") >= min_rows
    feeds = F.array(F.when(enough, F.col("_fine")), F.when(F.col("_parted") & spoken, F.col("_coarse")),
                    F.when(F.lit(bool(rare_languages)), everything))
    told = _small(counts.join(languages, "_coarse").select(
        "_fine", F.when(enough, F.col("_fine")).when(spoken, F.col("_coarse")).otherwise(everything).alias("cell"),
        F.array_compact(feeds).alias("feeds")), "cell-levels")
    return rows.withColumn("_fine", fine).join(told, "_fine").drop("_fine")


def _estimates(rows: DataFrame, z: list[Column], by: list[str], weight: Column | None = None) -> DataFrame:
    """Mean and the rows of the inverse Cholesky factor of the scatter, per ``by``."""
    inside = F.lit(True) if weight is None else weight
    sums = {"n": F.count_if(inside)}
    for i in range(P):
        sums[f"s{i}"] = F.sum(F.when(inside, z[i]))
        for j in range(i + 1):
            sums[f"q{i}{j}"] = F.sum(F.when(inside, z[i] * z[j]))
    moments = rows.groupBy(*by).agg(*[v.alias(k) for k, v in sums.items()])
    out = moments.withColumns({f"m{i}": F.round(F.col(f"s{i}") / F.col("n"), 9) for i in range(P)})
    out = out.withColumns({
        f"c{i}{j}": F.round(
            CONSISTENCY * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n"))
            + F.lit(FLOOR[i] ** 2 if i == j else 0.0), 9)
        for i in range(P) for j in range(i + 1)
    })
    return _factor(out).select(*by, "n", *[f"m{i}" for i in range(P)], *_factors(), "log_det")


def _small(df: DataFrame, name: str) -> DataFrame:
    """Store a table with a row or a few per cell in one file; its size then shows that it can be broadcast."""
    return stored(df.repartition(1), name)


def _factors() -> list[str]:
    return [f"w{i}{j}" for i in range(P) for j in range(i + 1)]


def _factor(df: DataFrame) -> DataFrame:
    """From scatter columns c<i><j>: w<i><j>, the inverse of the Cholesky factor, and log_det."""
    for j in range(P):
        rest = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - rest, F.lit(FLOOR[j] ** 2 / 100))))
        df = df.withColumns({
            f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)))
            / F.col(f"l{j}{j}") for i in range(j + 1, P)
        }) if j + 1 < P else df
    for i in range(P):
        df = df.withColumns({
            f"w{i}{j}": 1 / F.col(f"l{i}{i}") if i == j else
            -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}")
            for j in range(i + 1)
        })
    return df.withColumn("log_det", sum((2 * F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)))


def _distance() -> Column:
    """Squared Mahalanobis distance from the joined estimate."""
    z = [F.col(VECTOR[i]) - F.col(f"m{i}") for i in range(P)]
    return sum((sum((F.col(f"w{i}{j}") * z[j] for j in range(i + 1)), F.lit(0.0)) ** 2 for i in range(P)), F.lit(0.0))


def _starts(rows: DataFrame) -> DataFrame:
    """Three robust starts per cell: medians with diagonal scatter, wrapped scores, spatial signs."""
    medians = _small(rows.groupBy("cell").agg(
        *[F.percentile(F.round(x, 2), F.lit(0.5)).alias(f"d{i}") for i, x in enumerate(VECTOR)]), "medians")
    centred = rows.join(medians, "cell")
    spreads = _small(centred.groupBy("cell").agg(
        *[F.first(f"d{i}").alias(f"d{i}") for i in range(P)],
        *[F.greatest(1.4826 * F.percentile(F.round(F.abs(F.col(x) - F.col(f"d{i}")), 2), F.lit(0.5)), F.lit(FLOOR[i])).alias(f"e{i}")
          for i, x in enumerate(VECTOR)]), "spreads")
    scored = rows.join(spreads, "cell").withColumns(
        {f"z{i}": (F.col(x) - F.col(f"d{i}")) / F.col(f"e{i}") for i, x in enumerate(VECTOR)})
    length = F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(P)), F.lit(1e-9)))
    shapes = {0: [F.lit(0.0)] * P, 1: [F.tanh(f"z{i}") for i in range(P)], 2: [F.col(f"z{i}") / length for i in range(P)]}
    sums = scored.groupBy("cell").agg(
        *[F.first(f"{a}{i}").alias(f"{a}{i}") for a in "de" for i in range(P)],
        *[F.avg(shapes[s][i] * shapes[s][j]).alias(f"a{s}{i}{j}") for s in (1, 2) for i in range(P) for j in range(i + 1)])
    each = []
    for s in range(STARTS):
        scatter = []
        for i in range(P):
            for j in range(i + 1):
                if s == 0:
                    shape = F.lit(1.0 if i == j else 0.0)
                else:
                    shape = F.col(f"a{s}{i}{j}") / F.sqrt(F.greatest(F.col(f"a{s}{i}{i}") * F.col(f"a{s}{j}{j}"), F.lit(1e-12)))
                    shape = F.lit(1.0) if i == j else 0.95 * shape
                scatter.append(F.round(shape * F.col(f"e{i}") * F.col(f"e{j}"), 9).alias(f"c{i}{j}"))
        each.append(F.struct(F.lit(s).alias("start"), *scatter))
    begun = sums.withColumns({f"m{i}": F.col(f"d{i}") for i in range(P)})
    begun = begun.select("cell", *[f"m{i}" for i in range(P)], F.inline(F.array(*each)))
    return _factor(begun).select("cell", "start", *[f"m{i}" for i in range(P)], *_factors())


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Per ``cell`` the location and scatter of smallest determinant, over the rows of a stored table."""
    estimates = _small(_starts(rows), "mcd")
    step = F.round(32 * F.log(F.col("_d") + 1e-6))
    for _ in range(STEPS):
        near = rows.join(estimates, "cell").select("cell", "start", *VECTOR, _distance().alias("_d")).withColumn("_d", step)
        edges = _small(near.groupBy("cell", "start").agg(F.percentile("_d", F.lit(SHARE)).alias("_edge")), "mcd-edges")
        inside = near.join(edges, ["cell", "start"])
        estimates = _small(_estimates(
            inside, [F.col(x) for x in VECTOR], ["cell", "start"], F.col("_d") <= F.col("_edge")), "mcd")
    chosen = F.min_by(F.struct(*[c for c in estimates.columns if c not in ("cell", "start")]), F.struct("log_det", "start"))
    return _small(estimates.groupBy("cell").agg(chosen.alias("_best")).select("cell", "_best.*"), "mcd-best")


def judge_quality(docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """Statistics of every text with ``base_failed``, its squared ``distance`` and the verdict ``kept``."""
    facts = stored(_vectors(text_statistics(docs)), "statistics")
    rows = stored(_cells(facts, min_rows), "cells")
    estimates = robust_estimates(rows.where(~F.col("base_failed")).select(F.explode("feeds").alias("cell"), *VECTOR))
    # Without an estimate there is no text that passes the base limits.
    judged = rows.join(estimates, "cell", "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "cell", "distance",
    )
