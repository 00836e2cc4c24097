"""Column functions for names, addresses, numbers as text and display bands.

Pure Column -> Column functions: they run inside generated code and, stateless, on streaming
frames as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "—"  # em dash

# Words that do not count in company names, and countries expected of them.
STOP_WORDS = ["plc", "ltd", "limited", "group", "holdings", "inc", "corp", "corporation", "sa", "se", "nv", "ag", "the", "of", "and", "&"]
ALLOWED_COUNTRIES = ["GB", "IE", "JE", "GG", "CH", "ZA", "AU", "NL", "LU"]


def strip(c: Column) -> Column:
    """Trims white space as Unicode defines it, not only spaces."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def clean_name(name: Column) -> Column:
    """What stands in the first non-empty parentheses, else the name; trimmed."""
    inner = F.regexp_extract(name, r"\(([^)]+)\)", 1)
    return strip(F.when(inner != "", inner).otherwise(name))


def query_variants(name: Column) -> Column:
    """Names to search for, in order: the name, with plc, and both for the cleaned name."""
    cleaned, plc = clean_name(name), F.lit(" plc")
    plain = F.array(name, F.concat(name, plc))
    return F.when(cleaned != name, F.concat(plain, F.array(cleaned, F.concat(cleaned, plc)))).otherwise(plain)


def significant_words(name: Column) -> Column:
    """The set of ASCII words of a name, lower case, without stop words and single letters."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    words = F.transform(F.regexp_extract_all(name, F.lit(r"([a-zA-Z0-9]+)"), 1), F.lower)
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~F.array_contains(stop, w)))


def set_similarity(a: Column, b: Column) -> Column:
    """Common words by the size of the larger set; 0 if either is empty."""
    larger = F.greatest(F.size(a), F.size(b))
    filled = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(filled, F.size(F.array_intersect(a, b)) / larger).otherwise(F.lit(0.0))


def country_allowed(country: Column) -> Column:
    return F.coalesce(country.isin(ALLOWED_COUNTRIES), F.lit(False))


def source_type(url: Column) -> Column:
    """pdf, excel or html by the suffix before the first question mark; a fragment counts."""
    path = F.split_part(F.lower(url), F.lit("?"), F.lit(1))
    return F.when(path.endswith(".pdf"), "pdf").when(path.endswith(".xlsx") | path.endswith(".xls"), "excel").otherwise("html")


def archive_name(name: Column) -> Column:
    return F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))


def report_key(name: Column, year: Column | None = None) -> Column:
    """Where a report is archived."""
    folder = F.concat(F.lit("sources/"), archive_name(name), F.lit("/"))
    return F.concat(folder, F.lit("report.pdf")) if year is None else F.concat(folder, year.cast("string"), F.lit("_report.pdf"))


def screenshot_key(name: Column, page: Column) -> Column:
    return F.concat(F.lit("screenshots/"), archive_name(name), F.lit("/page_"), page.cast("string"), F.lit(".png"))


def preview(table: Column, size: int = 600) -> Column:
    return F.concat(F.substring(table, 1, size), F.when(F.length(table) > size, "...").otherwise(""))


def capped(text: Column, size: int = 50_000) -> Column:
    return F.substring(text, 1, size)


def search_query(name: Column) -> Column:
    return F.concat(name, F.lit(" greenhouse gas emissions scope 1 2 3 sustainability report annual report ESG"))


def percent_text(share: Column) -> Column:
    """A share as whole percents, halves to even."""
    return F.concat(F.bround(share * 100, 0).cast("decimal(38,0)").cast("string"), F.lit("%"))


def whole_text(v: Column) -> Column:
    """A number without decimals, thousands by commas, halves to even."""
    return F.format_number(v, 0)


def float_text(v: Column) -> Column:
    """A double as Python writes it: plain from 1e-4 up to 1e16, else with a short exponent."""
    plain = v.cast("string")
    fixed = F.regexp_replace(v.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    wide = F.regexp_replace(F.when(F.abs(v) < 1e16, v).cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.split_part(plain, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(plain, F.lit("E"), F.lit(2)).try_cast("int")
    exponent = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    size = F.abs(v)
    return (
        F.when(F.isnan(v), "nan")
        .when(size == float("inf"), F.when(v > 0, "inf").otherwise("-inf"))
        .when((size >= 1e7) & (size < 1e16), wide)
        .when((size >= 1e-4) & (size < 1e-3), F.when(size < 1, fixed))
        .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), exponent)
        .otherwise(plain)
    )


def shown(v: Column) -> Column:
    return F.when(v.isNotNull(), whole_text(v)).otherwise(UNKNOWN)


def shown_prior(v: Column) -> Column:
    """As in the list of prior years, where a zero counts as missing."""
    return F.when(v.isNotNull() & (v != 0), whole_text(v)).otherwise(UNKNOWN)


def confidence_band(score: Column) -> Column:
    return F.when(score.isNull(), F.lit(None).cast("string")).when(score >= 70, "green").when(score >= 40, "yellow").otherwise("red")


def or_default(c: Column, default: str) -> Column:
    """Null and empty become the default."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def lei_band(lei: Column, confidence: Column) -> Column:
    found = F.coalesce(lei, F.lit("")) != ""
    tier = or_default(confidence, "unknown")
    return F.when(~found, "Not found").when(tier == "high", "green").when(tier == "medium", "yellow").otherwise("red")
