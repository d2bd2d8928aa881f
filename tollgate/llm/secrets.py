"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed: its blob is the SHA-256 of its text. The
ledger is a folder of Parquet files with one row per (blob, rule version) that has been
scanned and its findings, an empty list where nothing was found. A scan looks only at pairs the
ledger does not have, once per blob however many paths hold it, appends them, and joins
the findings back to all paths.

Defined cases: a null text is the empty blob; paths may be null or repeat and each row gets
its blob's findings; an empty table gives no rows; columns other than the id and the text pass through
``redact`` and are left out by ``scan``. Very long texts are scanned whole. A match that fails its length rule uses up its
characters: the next match starts after it.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import let, stored, whole
from tollgate.sources.shared import shared_folder


@dataclass(frozen=True)
class Rule:
    """``group`` of the match must have ``least`` characters; ``begins`` is a cheap test for texts without a match."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    begins: str


#: A private key from its BEGIN line through its END line; no other line of five dashes may be between them. Without an END line:
#: headers and base64 lines up to the end of the last one, or, where the lines are indented, joined by spaces or escaped,
#: base64 characters and what joins them. The header alone where no key follows. What joins them is one class of characters, because
#: a choice between alternatives that repeats would take a frame of the stack for every character.
PEM = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:"
    r"[^-]*(?:-{1,4}[^-]+){0,200}-----END [A-Z ]{0,40}PRIVATE KEY-----"
    r"|(?:[\r\n]+[A-Za-z-]+:\x20[^\r\n]*){0,100}[\r\n]+[A-Za-z0-9+/=][A-Za-z0-9+/=\r\n]*(?:[\r\n]|\z)"
    r"|[\x20\t\r\n\\][\x20\t\r\n\\rnt]*[A-Za-z0-9+/=]{20}[A-Za-z0-9+/=\\\x20\t\r\n]*"
    r"|)"
)
#: Kinds in the order in which equal starts are listed; the first three are the base rules.
RULES = [
    Rule("assign", 1,
         r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
         r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, ""),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, ""),
    Rule("pem", 3, PEM, 0, 27, "PRIVATE KEY"),
    Rule("hosted", 1, r"(?:gh[pousr]_|glpat-|xox[abprs]-)[A-Za-z0-9_-]{16,}", 0, 20, ""),
]
#: Matches of a text are added up in blocks of so many.
BLOCK = 512
#: Characters in a piece of a text that secrets are cut out of.
PIECE = 4096
BASE = ["assign", "access", "hex"]
FINDING = "array<struct<kind:string,start:bigint,stop:bigint>>"


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of one rule, from the matches and the texts between them."""
    # Only runs that reach the length matter for a rule whose whole match is measured and greedy.
    pattern = rule.pattern
    if rule.kind == "hex":
        pattern = r"[0-9a-f]{32,}"

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        sized = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda whole_match, gap: F.struct(
            F.char_length(gap).cast("bigint").alias("gap"), F.char_length(whole_match).cast("bigint").alias("length")))
        zero = F.lit(0).cast("bigint")

        def total(part: Column) -> Column:
            return F.aggregate(part, zero, lambda t, x: t + x["gap"] + x["length"])

        def spans(s: Column, before: Column) -> Column:
            def span(i: Column) -> Column:
                block = F.floor((i - 1) / BLOCK).cast("int")
                stop = F.element_at(before, block + 1) + total(F.slice(s, block * BLOCK + 1, i - block * BLOCK))
                return let(stop, lambda e: F.struct(
                    F.lit(rule.kind).alias("kind"), (e - F.element_at(s, i)["length"]).alias("start"), e.alias("stop")))

            return F.transform(F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: _long_enough(F.element_at(found, i), rule)), span)

        # Where every block of matches begins, from the blocks' totals: no match adds up all those before it.
        blocks = let(sized, lambda s: F.struct(s.alias("s"), F.transform(
            F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(s, b * BLOCK + 1, F.lit(BLOCK)))).alias("totals")))
        begun = let(blocks, lambda x: F.struct(x["s"].alias("s"), F.transform(
            F.sequence(F.lit(0), F.size(x["totals"]) - 1), lambda b: F.aggregate(F.slice(x["totals"], F.lit(1), b), zero, lambda t, y: t + y)).alias("before")))
        return let(begun, lambda x: spans(x["s"], x["before"]))

    none = F.array().cast(FINDING)
    seen = text.rlike(pattern) if not rule.begins else text.contains(rule.begins) & text.rlike(pattern)
    return F.when(seen, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none).cast(FINDING)


def _long_enough(match: Column, rule: Rule) -> Column:
    value = match if rule.group == 0 else F.regexp_extract(match, rule.pattern, rule.group)
    return F.char_length(value) >= rule.least


def address(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``blob``, the digest that names the content of this row."""
    return df.withColumn("blob", F.sha2(whole(text), 256))


def _ledger(df: DataFrame, path: str) -> DataFrame | None:
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException:  # nothing has been scanned yet
        return None


def scan(versions: DataFrame, ledger: str, rules: list[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan what the ledger lacks, extend it, and return ``key``, ``blob`` and ``findings`` of every row.

    ``versions`` has one row per path and version. Findings are in order of start, then of the rules.
    """
    spark = versions.sparkSession
    paths = stored(address(versions.select(key, text), text).select(key, "blob"), "paths")
    blobs = paths.groupBy("blob").agg(F.min(key).alias("_path"))
    pairs = blobs.withColumn("rule", F.explode(F.array(*[F.lit(f"{r.kind}/{r.version}") for r in rules])))
    known = _ledger(versions, ledger)
    if known is not None:
        pairs = pairs.join(known.select("blob", "rule"), ["blob", "rule"], "left_anti")
    unseen = pairs.groupBy("blob", "_path").agg(F.collect_set("rule").alias("_rules"))
    # The bytes come from one path of the blob. The path is part of the key, so copies spread over the tasks.
    source = address(versions.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text").withColumnRenamed("blob", "_blob")
    opened = unseen.join(source, (F.col("blob") == F.col("_blob")) & F.col("_path").eqNullSafe(F.col("_key")))
    content = whole("_text")
    per_rule = [
        F.when(F.array_contains("_rules", f"{r.kind}/{r.version}"), F.struct(
            F.lit(f"{r.kind}/{r.version}").alias("rule"), _spans(content, r).alias("spans")))
        for r in rules
    ]
    scanned = opened.select("blob", F.inline(F.filter(F.array(*per_rule), lambda x: x.isNotNull())))
    # A repeated row opens its blob twice with equal findings.
    scanned.groupBy("blob", "rule").agg(F.any_value("spans").alias("spans")).write.mode("append").parquet(ledger)
    order = {f"{r.kind}/{r.version}": i for i, r in enumerate(rules)}
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    hits = spark.read.parquet(ledger).where(F.col("rule").isin(list(order)) & (F.size("spans") > 0))
    ranked = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.element_at(ranks, F.col("rule")).alias("rank"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    # At most one row per rule and blob is gathered.
    found = hits.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(ranked))).alias("_all"))
    tidy = F.transform("_all", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return paths.join(found.select("blob", tidy.alias("findings")), "blob", "left").select(
        key, "blob", F.coalesce("findings", F.array().cast(FINDING)).alias("findings"))


def new_ledger(df: DataFrame) -> str:
    """An empty ledger's place in the shared folder."""
    return f"{shared_folder(df.sparkSession)}/llm/ledger-{uuid4().hex}"


def span_list(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _without(text: Column, found: Column, mark: str) -> Column:
    """The text with a mark for every run of overlapping spans; ``found`` is in order of start.

    Where earlier spans end is added up by blocks of spans, and clear parts come from pieces of the text, so the
    work per span is bounded: it does not grow with the text or the spans before.
    """
    zero = F.lit(0).cast("bigint")

    def last_stop(part: Column) -> Column:
        return F.aggregate(part, zero, lambda t, x: F.greatest(t, x["stop"]))

    def clear(pieces: Column, start: Column, stop: Column) -> Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor(stop / PIECE).cast("int")
        return F.substring(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""),
                           (F.pmod(start, F.lit(PIECE)) + 1).cast("int"), (stop - start).cast("int"))

    def assembled(x: Column) -> Column:
        def part(i: Column) -> Column:
            block = F.floor((i - 1) / BLOCK).cast("int")
            at = F.greatest(F.element_at(x["before"], block + 1), last_stop(F.slice(x["s"], block * BLOCK + 1, i - 1 - block * BLOCK)))
            return let(F.struct(at.alias("at"), F.element_at(x["s"], i)["start"].alias("start")), lambda y: F.when(
                y["start"] >= y["at"], F.concat(clear(x["pieces"], y["at"], y["start"]), F.lit(mark))).otherwise(""))

        parts = F.transform(F.sequence(F.lit(1), F.size(x["s"])), part)
        return F.concat(F.array_join(parts, ""), clear(x["pieces"], last_stop(x["s"]), F.char_length(text).cast("bigint")))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    stops = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")),
                        lambda b: last_stop(F.slice(found, b * BLOCK + 1, F.lit(BLOCK))))
    before = let(stops, lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 1), lambda b: F.aggregate(
        F.slice(t, F.lit(1), b), zero, lambda m, y: F.greatest(m, y))))
    return let(F.struct(found.alias("s"), before.alias("before"), pieces.alias("pieces")), assembled)


def redact(docs: DataFrame, ledger: str, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced; overlapping spans become one mark.

    Rows without findings keep their text, null included; ``n_chars`` follows the text where it is replaced.
    """
    found = scan(docs, ledger).where(F.size("findings") > 0).groupBy("blob").agg(F.any_value("findings").alias("found"))
    # The row travels as one value, so its columns cannot clash with those added here.
    boxed = docs.select(F.struct(*docs.columns).alias("row"), F.sha2(whole("text"), 256).alias("blob"))
    marked = boxed.join(found, "blob", "left")
    text = F.col("row.text")
    cleaned = _without(text, F.col("found"), mark)
    out = marked.withColumn("cleaned", F.when(F.col("found").isNotNull(), cleaned))
    changed = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("bigint")}
    return out.select(*[
        (F.when(F.col("cleaned").isNotNull(), changed[c]).otherwise(F.col(f"row.`{c}`")) if c in changed else F.col(f"row.`{c}`")).alias(c)
        for c in docs.columns])
