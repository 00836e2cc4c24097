"""The ordered quality checks on records, fused into one pass.

Order matters: range, unit, year on year, low confidence, missing scopes. All but the
year-on-year check look only at records that are still pending when their turn comes; that
one looks at all records, whatever their status, and repeats its reasons on a second run.
The suite costs one shuffle, by company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import float_text, percent_text, whole_text

# Thresholds of the checks.
SCOPE_1_MAX = 500_000_000
SCOPE_3_MAX = 2_000_000_000
FIRST_YEAR = 2000
YOY_LIMIT = 0.5
LOW_CONFIDENCE = 50
SUSPICIOUS_UNITS = ["kt co2e", "kt", "mt co2e", "mt"]

#: fixed order where a company has several records of a year
ORDER = ["reporting_year", "extraction_date", "id"]
SCOPES_COMPARED = {"Scope 1": "scope_1", "Scope 2 (location)": "scope_2_location", "Scope 3": "scope_3"}


def joined(*reasons: Column, sep: str = "; ") -> Column:
    """The reasons that are there, or null if none is."""
    return F.nullif(F.concat_ws(sep, *reasons), F.lit(""))


def add_reason(old: Column, new: Column) -> Column:
    """Appends to what was there, if anything was."""
    return F.concat_ws("; ", F.nullif(old, F.lit("")), new)


def _number(v: Column) -> Column:
    """NaN compares as false everywhere, as in Python."""
    return F.when(~F.isnan(v), v)


def _negative(name: str, v: Column) -> Column:
    return F.when(_number(v) < 0, F.concat(F.lit(f"{name} is negative ("), float_text(v), F.lit(")")))


def _too_high(name: str, v: Column, most: int) -> Column:
    return F.when(_number(v) > most, F.concat(F.lit(f"{name} implausibly high ("), whole_text(v), F.lit(")")))


def range_reason(current_year: int) -> Column:
    year = F.col("reporting_year")
    return joined(
        _negative("Scope 1", F.col("scope_1")),
        _too_high("Scope 1", F.col("scope_1"), SCOPE_1_MAX),
        _negative("Scope 2 (location)", F.col("scope_2_location")),
        _negative("Scope 2 (market)", F.col("scope_2_market")),
        _negative("Scope 3", F.col("scope_3")),
        _too_high("Scope 3", F.col("scope_3"), SCOPE_3_MAX),
        F.when((year < FIRST_YEAR) | (year > current_year), F.concat(F.lit("Reporting year out of range ("), year.cast("string"), F.lit(")"))),
    )


def unit_reason() -> Column:
    unit = F.col("unit")
    return F.when(F.lower(unit).isin(SUSPICIOUS_UNITS), F.concat(F.lit("Unit is '"), unit, F.lit("' — values may not be in tonnes CO2e")))


def previous_record() -> Column:
    """The record before, of the same company, in the fixed order."""
    w = Window.partitionBy("company_id").orderBy(*ORDER)
    return F.lag(F.struct("reporting_year", *SCOPES_COMPARED.values())).over(w)


def yoy_reasons(prev: Column) -> Column:
    """Array of the changes by more than half against the year before."""
    found = []
    for name, column in SCOPES_COMPARED.items():
        now, then = _number(F.col(column)), _number(prev[column])
        change = F.abs(now - then) / then
        way = F.when(now > then, "increase").otherwise("decrease")
        text = F.concat(
            F.lit(f"{name}: "), percent_text(change), F.lit(" "), way, F.lit(" vs "), prev["reporting_year"].cast("string"), F.lit(" ("), whole_text(then), F.lit(" -> "), whole_text(now), F.lit(")")
        )
        # the division stands inside the condition's branch: then > 0 is tested first
        found.append(F.when((then > 0) & (now != 0), F.when(change > YOY_LIMIT, text)))
    follows = F.col("reporting_year") == prev["reporting_year"] + 1
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(follows, F.array_compact(F.array(*found))), none)


def confidence_reason(threshold: int = LOW_CONFIDENCE) -> Column:
    score = F.col("confidence_score")
    return F.when(score < threshold, F.concat(F.lit("Low confidence score ("), score.cast("string"), F.lit("/100)")))


def missing_reason() -> Column:
    names = joined(
        F.when(F.col("scope_1").isNull(), "Scope 1"),
        F.when(F.col("scope_2_location").isNull() & F.col("scope_2_market").isNull(), "Scope 2"),
        F.when(F.col("scope_3").isNull(), "Scope 3"),
        sep=", ",
    )
    return F.concat(F.lit("Missing: "), names)


REASONS = ["range_reason", "unit_reason", "yoy_reasons", "confidence_reason", "missing_reason"]


def with_reasons(records: DataFrame, current_year: int, low_confidence: int = LOW_CONFIDENCE) -> DataFrame:
    """Adds the reason that each check gives, in their order; null where it gives none or does
    not look at the record."""
    pending = F.col("review_status") == "pending"
    out = records.withColumn("_prev", previous_record()).withColumn("yoy_reasons", yoy_reasons(F.col("_prev"))).drop("_prev")
    out = out.withColumn("range_reason", F.when(pending, range_reason(current_year)))
    out = out.withColumn("unit_reason", F.when(pending & F.col("range_reason").isNull(), unit_reason()))
    left = pending & F.col("range_reason").isNull() & F.col("unit_reason").isNull() & (F.size("yoy_reasons") == 0)
    out = out.withColumn("confidence_reason", F.when(left, confidence_reason(low_confidence)))
    return out.withColumn("missing_reason", F.when(left & F.col("confidence_reason").isNull(), missing_reason()))


def flag(reasoned: DataFrame) -> DataFrame:
    """Folds the reasons into status and flag_reason."""
    new = joined(F.col("range_reason"), F.col("unit_reason"), F.nullif(F.array_join("yoy_reasons", "; "), F.lit("")), F.col("confidence_reason"), F.col("missing_reason"))
    any_reason = new.isNotNull()
    return reasoned.withColumns(
        {
            "flag_reason": F.when(any_reason, add_reason(F.col("flag_reason"), new)).otherwise(F.col("flag_reason")),
            "review_status": F.when(any_reason, "flagged").otherwise(F.col("review_status")),
        }
    ).drop(*REASONS)


def run_all_checks(records: DataFrame, current_year: int, low_confidence: int = LOW_CONFIDENCE) -> DataFrame:
    """The records with status and flag_reason after the whole suite."""
    return flag(with_reasons(records, current_year, low_confidence))


def check_counts(records: DataFrame, current_year: int, low_confidence: int = LOW_CONFIDENCE) -> DataFrame:
    """One row: records flagged by each check (for year on year, its reasons), and how many
    records are flagged and pending in the end."""
    return with_reasons(records, current_year, low_confidence).agg(*count_columns())


def count_columns() -> list[Column]:
    """The counts of ``check_counts`` over the rows of ``with_reasons``, for an aggregation or to
    observe them while the rows are written."""
    touched = (
        F.col("range_reason").isNotNull() | F.col("unit_reason").isNotNull() | (F.size("yoy_reasons") > 0) | F.col("confidence_reason").isNotNull() | F.col("missing_reason").isNotNull()
    )
    return [
        F.count_if(F.col("range_reason").isNotNull()).alias("range_flags"),
        F.count_if(F.col("unit_reason").isNotNull()).alias("unit_flags"),
        F.coalesce(F.sum(F.size("yoy_reasons").cast("long")), F.lit(0)).alias("yoy_flags"),
        F.count_if(F.col("confidence_reason").isNotNull()).alias("confidence_flags"),
        F.count_if(F.col("missing_reason").isNotNull()).alias("missing_flags"),
        F.count_if(touched | (F.col("review_status") == "flagged")).alias("flagged"),
        F.count_if(~touched & (F.col("review_status") == "pending")).alias("pending"),
    ]


def single_check(records: DataFrame, reason: Column) -> DataFrame:
    """One of the row-level checks alone, on pending records; stateless, so it also runs on a
    streaming frame."""
    hit = F.when(F.col("review_status") == "pending", reason)
    return records.withColumn("_r", hit).withColumns(
        {
            "flag_reason": F.when(F.col("_r").isNotNull(), add_reason(F.col("flag_reason"), F.col("_r"))).otherwise(F.col("flag_reason")),
            "review_status": F.when(F.col("_r").isNotNull(), "flagged").otherwise(F.col("review_status")),
        }
    ).drop("_r")


def yoy_check(records: DataFrame) -> DataFrame:
    """The year-on-year check alone, on all records."""
    r = records.withColumn("_r", F.array_join(yoy_reasons(previous_record()), "; "))
    hit = F.col("_r") != ""
    return r.withColumns(
        {
            "flag_reason": F.when(hit, add_reason(F.col("flag_reason"), F.col("_r"))).otherwise(F.col("flag_reason")),
            "review_status": F.when(hit, "flagged").otherwise(F.col("review_status")),
        }
    ).drop("_r")
