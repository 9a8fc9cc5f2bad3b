"""Column expressions for cleaning and feature engineering.

Every function takes and returns Columns, so the whole expression stays inside
generated code; bad input becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.languages import language_map

AGE_BINS = [(0, 18, "0-18"), (18, 25, "19-25"), (25, 35, "26-35"), (35, 50, "36-50"), (50, 100, "50+")]
COLD_START = {"age": -1, "occupation": "other or not specified", "gender": "U"}


def number(c: Column) -> Column:
    """DOUBLE value of a column, NULL when it is no number or NaN."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def integer_id(c: Column) -> Column:
    """Identifier written as '12', '12.0' or ' 12 '."""
    value = number(F.trim(c.cast("string")))
    return value.try_cast("bigint")


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a value; NULL stays NULL (greatest/least alone would skip it)."""
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def age_bin(age: Column) -> Column:
    """Right-closed age bands; outside (0, 100] there is no band."""
    return reduce(
        lambda expr, band: expr.when((age > band[0]) & (age <= band[1]), band[2]), AGE_BINS, F
    )


def year_of(text: Column) -> Column:
    return F.year(F.try_to_date(text))


def tokens(text: Column) -> Column:
    """Trimmed, non-empty parts of a comma list; NULL gives an empty array."""
    parts = F.transform(F.split(text, ","), lambda t: F.trim(t))
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def language_codes(spoken: Column, original: Column) -> Column:
    """Distinct ISO codes of the spoken languages, the original language when none is listed."""
    names = tokens(F.regexp_replace(F.coalesce(spoken, original), ";", ","))
    lookup = language_map()
    return F.array_distinct(F.transform(names, lambda n: F.coalesce(F.try_element_at(lookup, n), n)))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def completion(minutes: Column, duration: Column) -> Column:
    """Share of the runtime reached; a zero runtime counts as complete once anything was watched."""
    share = ratio(minutes, duration)
    return clip(F.when(duration == 0, F.when(minutes > 0, 1.0)).otherwise(share), 0.0, 1.0)


def frequency(count: Column, duration: Column) -> Column:
    return F.log1p(count) / F.log1p(F.greatest(duration, F.lit(1.0)))


def percentage(c: Column, default: float) -> Column:
    """Percentage kept within [0, 100]; missing or malformed input takes the default."""
    return clip(F.coalesce(number(c), F.lit(float(default))), 0.0, 100.0)


def served_items(payload: Column) -> Column:
    """Item list of a served payload.

    Accepts a JSON object holding ``recommendations`` (plain ids or objects with
    ``item_id``), a JSON array, comma-separated text, or one bare token.
    """
    document = F.try_parse_json(payload)
    listed = F.coalesce(
        F.try_variant_get(document, "$.recommendations", "array<variant>"),
        F.try_variant_get(document, "$", "array<variant>"),
    )
    from_json = F.transform(
        listed,
        lambda v: F.coalesce(F.try_variant_get(v, "$.item_id", "string"), F.try_variant_get(v, "$", "string")),
    )
    empty = F.array().cast("array<string>")
    return (
        F.when(listed.isNotNull(), from_json)
        .when(document.isNotNull(), empty)
        .otherwise(tokens(payload))
    )


def row_fingerprint(*columns: str) -> Column:
    """SHA-256 of the row as compact JSON with its keys in alphabetical order."""
    ordered = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def share_limit(share: float) -> str:
    """Eight hexadecimal digits that a fraction ``share`` of all such digits lies below."""
    return format(round(share * 16**8), "08x") if share < 1 else "g"


def in_share(share: float, *keys: Column, seed: int = 42) -> Column:
    """True for a fixed ``share`` of the key combinations.

    The keys are mixed by MD5, so ids in steps of ten spread like any others, and any engine with MD5
    finds the same rows.
    """
    return F.substring(mixed(*keys, seed=seed), 1, 8) < F.lit(share_limit(share))


def mixed(*keys: Column, seed: int = 42) -> Column:
    """MD5 of the seed and the keys, joined by colons."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))
