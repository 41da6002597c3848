"""Text, number and URL functions, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlencode

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() takes off.
PYTHON_WHITESPACE = "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def clean_doi(c: Column) -> Column:
    """A DOI without white space around it and without line feeds, tabs and double quotes; NULL for NULL and `''`.

    White space is taken off first, so a blank inside quotes stays, and white space alone becomes `''`, not NULL.
    """
    stripped = F.translate(F.btrim(c, F.lit(PYTHON_WHITESPACE)), '\n\t"', "")
    return F.when(c.isNotNull() & (c != ""), stripped)


def clean_text(c: Column) -> Column:
    """Line feeds, carriage returns and tabs as blanks, runs of blanks as one; nothing is taken off the ends."""
    return F.regexp_replace(F.translate(c, "\n\r\t", "   "), " +", " ")


def list_or_scalar(variant: Column, path: str) -> Column:
    """Text at a VARIANT's path that is a list (joined by blanks) or a scalar."""
    joined = F.array_join(F.try_variant_get(variant, path, "array<string>"), " ")
    return F.coalesce(joined, F.try_variant_get(variant, path, "string"))


def elements(variant: Column, path: str, text_is_json: bool = False) -> Column:
    """The elements at a VARIANT's path as an array: of a list, of one value in its place, or, with `text_is_json`, of what JSON text holds.

    NULL for a missing or null value, an empty text and a text that is no JSON where it should be.
    """
    raw = F.try_variant_get(variant, path, "variant")
    if text_is_json:
        raw = F.when(F.schema_of_variant(raw) == "STRING", F.try_parse_json(F.try_variant_get(variant, path, "string"))).otherwise(raw)

    def of(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        empty = (kind == "VOID") | ((kind == "STRING") & (F.try_variant_get(v, "$", "string") == ""))
        return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(~empty, F.array(v))

    # A one-element transform binds the value, so it is parsed once.
    return F.get(F.transform(F.array(raw), of), F.lit(0))


def plain_text(variant: Column) -> Column:
    """A scalar VARIANT as text, NULL for lists and objects."""
    return F.when(~F.schema_of_variant(variant).rlike("^(ARRAY|OBJECT)"), F.try_variant_get(variant, "$", "string"))


def utc_now() -> Column:
    """The present time in UTC as ISO text, the same for all rows of a query."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def first_or_null(c: Column) -> Column:
    return F.get(c, F.lit(0))


def size_or_null(c: Column) -> Column:
    """Array length, NULL for a missing array."""
    return F.when(c.isNotNull(), F.size(c))


def pipe_joined(c: Column) -> Column:
    """Elements joined by `|` without escaping; `''` for a missing array."""
    return F.coalesce(F.array_join(c, "|"), F.lit(""))


def bool_literal_number(c: Column) -> Column:
    """True/true as '1', False/false as '0', any other text as it is."""
    return F.when(c.isin("True", "true"), "1").when(c.isin("False", "false"), "0").otherwise(c)


# What counts as a number in text.
NUMBER = r"^\s*[+-]?(\d+([.]\d*)?([eE][+-]?\d+)?|[.]\d+([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity|INFINITY)\s*$"


def number_or_null(c: Column) -> Column:
    """Text as a double if it reads as a number (booleans as 1 and 0), else NULL; type suffixes such as `1d` are no numbers."""
    text = bool_literal_number(c)
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def safe_mean(total: Column, count: Column) -> Column:
    """total / count; 0 without any."""
    return F.when(count == 0, F.lit(0.0)).otherwise(total / F.nullif(count, F.lit(0)))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def year_of(c: Column) -> Column:
    """The year in UTC of an ISO timestamp, whatever the session's time zone; malformed text raises."""
    return F.year(F.to_utc_timestamp(F.to_timestamp(c), F.current_timezone()))


def equal_ignoring_case(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def contains_ignoring_case(c: Column, part: str) -> Column:
    """False for NULL."""
    return F.coalesce(F.lower(c).contains(part.lower()), F.lit(False))


def format_count(c: Column) -> Column:
    return F.format_number(c, 0)


def format_percent(c: Column) -> Column:
    return F.concat(F.format_number(c, 2), F.lit("%"))


def populated_keys(ref: Column) -> Column:
    """The sorted keys of a map whose values are neither NULL nor empty, joined by `|`."""
    return F.array_join(F.sort_array(F.map_keys(F.map_filter(ref, lambda _, v: v.isNotNull() & (v != "")))), "|")


def with_parameters(base_url: str, parameters: Mapping | list | None) -> str:
    """The URL with encoded parameters added after `?` or `&`; unchanged without any."""
    if not parameters:
        return base_url
    return f"{base_url}{'&' if '?' in base_url else '?'}{parameters if isinstance(parameters, str) else urlencode(parameters)}"


def next_cursor(content: Column) -> Column:
    """The next cursor of a page, from the whole page."""
    return F.get_json_object(content, "$.message.next-cursor")


def total_results(content: Column) -> Column:
    return F.get_json_object(content, "$.message.total-results").try_cast("bigint")
