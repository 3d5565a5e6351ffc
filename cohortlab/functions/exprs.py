"""Column expressions used across the library.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen. Clips keep NULL as NULL (``greatest(NULL, 1)`` would give 1).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab import schema as S

# Formats that a text column of days may have, month before day where both fit.
DAY_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy",
               "dd/MM/yyyy", "dd.MM.yyyy", "yyyyMMdd")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lo(c: str | Column, k: float) -> Column:
    c = col(c)
    return F.when(c < F.lit(k), F.lit(k)).otherwise(c)


def clip_hi(c: str | Column, k: float) -> Column:
    c = col(c)
    return F.when(c > F.lit(k), F.lit(k)).otherwise(c)


def clip(c: str | Column, lo: float, hi: float) -> Column:
    return clip_hi(clip_lo(c, lo), hi)


def ratio(num: str | Column, den: str | Column, floor: float) -> Column:
    """``num / max(den, floor)``; the floored denominator never divides by zero."""
    return col(num) / clip_lo(den, floor)


def nan_to_null(c: str | Column) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def inf_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(F.abs(c) == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(c)


def flag(cond: Column) -> Column:
    """Boolean to 0/1 long with NULL counted as 0, like a pandas mask cast to int."""
    return F.coalesce(cond.cast("long"), F.lit(0).cast("long"))


def replace_values(c: str | Column, mapping: Mapping[str, str]) -> Column:
    c = col(c)
    out = None
    for old, new in mapping.items():
        out = (F.when(c == F.lit(old), F.lit(new)) if out is None
               else out.when(c == F.lit(old), F.lit(new)))
    return c if out is None else out.otherwise(c)


def strip_ws(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def norm_channel(c: str | Column = "channel") -> Column:
    """Lower-case, keep ``[a-z0-9_]`` only, then fold synonyms. Lower-cased text has no
    A-Z, so ``\\W`` is that class; spelled out, the search took ten times as long."""
    cleaned = F.regexp_replace(F.lower(col(c)), r"\W", "")
    return replace_values(cleaned, S.CHANNEL_MAP)


def norm_country(c: str | Column = "country_code") -> Column:
    """Upper-case, strip, fold synonyms; anything not two letters (or NULL) -> XX."""
    mapped = replace_values(strip_ws(F.upper(col(c))), S.COUNTRY_MAP)
    return F.when(mapped.rlike("^[A-Z]{2}$"), mapped).otherwise(F.lit(S.INVALID_COUNTRY))


def norm_os(c: str | Column = "os_name") -> Column:
    low = F.lower(col(c))
    return (F.when(low.rlike("ios|iphone|ipad"), F.lit("iOS"))
            .when(low.contains("android"), F.lit("Android"))
            .otherwise(low))


_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(c: str | Column = "game_genre") -> Column:
    """Python-style title case: capital after every uncased character, then strip.

    ``initcap`` capitalises after spaces only (``Role-playing``); here the text
    is cut into cased / uncased runs and each cased run is capitalised. Text that
    is one run of A-Z and a-z needs no cutting.
    """
    c = col(c)
    runs = F.regexp_extract_all(c, F.lit(f"[{_CASED}]+|[^{_CASED}]+"), 0)

    def capital(r: Column) -> Column:
        return F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))

    titled = F.transform(runs, lambda r: F.when(r.rlike(f"^[{_CASED}]"), capital(r)).otherwise(r))
    return strip_ws(F.when(c.rlike(r"^[A-Za-z]+\s*$"), capital(c)).otherwise(F.array_join(titled, "")))


def parse_day(c: str | Column = "day", fmt: str = "yyyy-MM-dd") -> Column:
    """Coercing date parse: a value that does not parse becomes NULL."""
    return F.to_date(F.try_to_timestamp(col(c), F.lit(fmt)))


def infer_day_format(df: DataFrame, c: str = "day", formats=DAY_FORMATS) -> str | None:
    """The format of a text column of days: the candidate that most values have, the
    earlier candidate on ties, None if no value has any. Each distinct value is parsed once
    and counts as often as it comes, so the answer does not depend on row order. Date and
    timestamp columns need no format."""
    if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    values = df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("times"))
    fits = [F.try_to_timestamp("value", F.lit(f)).isNotNull() for f in formats]
    counts = values.agg(*[F.coalesce(F.sum(F.when(fit, F.col("times"))), F.lit(0)).alias(f"f{i}") for i, fit in enumerate(fits)]).first()
    best = max(range(len(formats)), key=lambda i: (counts[i], -i))
    return formats[best] if counts[best] else None


def parse_day_inferred(df: DataFrame, c: str = "day", formats=DAY_FORMATS) -> Column:
    """Coercing date parse of a date, timestamp or text column in the format it has;
    values of another format become NULL."""
    if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(c).cast("date")
    fmt = infer_day_format(df, c, formats)
    return parse_day(c, fmt) if fmt else F.lit(None).cast("date")


def hash_bits(key: str | Column, salt: str) -> Column:
    """32-bit unsigned hash of ``salt|key`` as a long, from md5 (engine independent)."""
    digest = F.md5(F.concat(F.lit(f"{salt}|"), col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
