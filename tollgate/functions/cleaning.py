"""Column expressions that turn messy text into typed values; bad input becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings.
TRUE_WORDS = ["1", "true", "yes", "y"]
FALSE_WORDS = ["0", "false", "no", "n"]
EMULATOR_TRUE = ["1", "true", "TRUE", "True", "yes", "YES", "Yes"]
EMULATOR_FALSE = ["0", "false", "FALSE", "False", "no", "NO", "No"]
CHANNEL_SYNONYMS = {
    "WEB": ["WEB", "ONLINE"],
    "MOBILE": ["MOBILE", "APP"],
    "POS": ["POS", "POINT_OF_SALE"],
    "API": ["API"],
}
AUTH_RESULTS = {"APPROVED": ["APPROVED"], "DECLINED": ["DECLINED"]}
DECIMAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
# Timestamps are year-month-day hour:minute:second; one-digit parts are allowed.
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
HIGH_AMOUNT = 10000


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def parse_timestamp(text: Column) -> Column:
    """Zoneless timestamp. A guarded try_cast does not depend on the session zone."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


def parse_amount(text: Column) -> Column:
    """DECIMAL(12,2); exponents, signs other than minus, and overflow give NULL."""
    return F.when(text.rlike(DECIMAL_PATTERN), text.try_cast("decimal(12,2)"))


def parse_flag(text: Column) -> Column:
    """True, false, or NULL for anything that is neither."""
    word = F.lower(text)
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def parse_emulator(text: Column) -> Column:
    return F.when(text.isin(EMULATOR_TRUE), 1).when(text.isin(EMULATOR_FALSE), 0)


def standardise(text: Column, groups: dict[str, list[str]]) -> Column:
    """Map spellings to their group name; other text is OTHER, NULL stays NULL."""
    word = F.upper(text)
    result = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, spellings in groups.items():
        result = result.when(word.isin(spellings), F.lit(name))
    return result.otherwise(F.lit("OTHER"))


def standardise_country(text: Column) -> Column:
    """Upper case when the text is exactly two bytes long."""
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(F.octet_length(text) == 2, F.upper(text))
        .otherwise(F.lit("OTHER"))
    )


def true_or_false(condition: Column) -> Column:
    """A condition that is NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def collate_keys(df: DataFrame, columns: list[str], collation: str = "UNICODE_CI_AI_RTRIM") -> DataFrame:
    """Give key columns a collation that ignores case, accents and trailing spaces.

    Joins, grouping and window partitions downstream then compare keys that way.
    """
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})
