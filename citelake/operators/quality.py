"""Column profiles per load and overall, and the loads that stand out.

Rows go through one histogram per (load, column, value); every statistic comes from it: counts, nulls, distinct values,
ranges and exact power sums (decimals). Power sums merge by addition, so the overall profile and a load's difference from
the rest need no second look at the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.session import materialise

EXACT = "decimal(38,0)"
LONGEST = 64


def histogram(df: DataFrame, load: str, columns: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """(load, column_name, value, digested, broken, n): hot values are combined before the shuffle.

    `value` is the text; one longer than `LONGEST` characters goes by its digest, so wide columns stay cheap to tell apart.
    `broken` tells whether the text violates its column's pattern.
    """
    patterns = patterns or {}

    def cell(c: str):
        text = F.col(f"`{c}`").cast("string")
        long = F.coalesce(F.length(text) > LONGEST, F.lit(False))
        broken = F.coalesce(~text.rlike(patterns[c]), F.lit(False)) if c in patterns else F.lit(False)
        return F.struct(F.lit(c).alias("column_name"), F.when(long, F.sha2(text, 256)).otherwise(text).alias("value"), long.alias("digested"), broken.alias("broken"))

    long = df.select(F.col(f"`{load}`").alias("load"), F.explode(F.array(*[cell(c) for c in columns])).alias("c")).select("load", "c.*")
    return long.groupBy("load", "column_name", "value", "digested", "broken").agg(F.count("*").alias("n"))


def _statistics(low: int, high: int) -> list[Column]:
    n, v = F.col("n"), F.col("value")
    number = F.when(~F.col("digested") & v.rlike(r"^[+-]?[0-9]{1,37}([.]0*)?$"), v.try_cast(EXACT))
    outside = number.isNotNull() & ((number < low) | (number > high))
    inside = F.when(number.isNotNull() & ~outside, number)

    def power(k: int) -> Column:
        term = n.cast(EXACT)
        for _ in range(k):
            term = (term * inside).cast(EXACT)
        return F.coalesce(F.sum(F.when(inside.isNotNull(), term)), F.lit(0)).cast(EXACT)

    return [
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("n_null"),
        F.count(v).alias("n_distinct"),
        F.coalesce(F.sum(F.when(outside, n)), F.lit(0)).alias("n_outside"),
        F.coalesce(F.sum(F.when(F.col("broken"), n)), F.lit(0)).alias("n_broken"),
        F.coalesce(F.sum(F.when(inside.isNotNull(), n)), F.lit(0)).alias("n_valid"),
        F.min(inside).alias("lowest"),
        F.max(inside).alias("highest"),
        *[power(k).alias(f"s{k}") for k in range(1, 5)],
    ]


def profile_loads(df: DataFrame, *, load: str, columns: list[str], low: int = 0, high: int = 10_000, patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per load and column plus one per column over all loads (`overall` true, `load` null).

    Columns: n_rows, n_null, n_distinct (non-null), n_outside (numbers outside [low, high]), n_broken (values that a column's
    pattern does not find), n_valid (numbers inside), lowest, highest and the exact power sums s1..s4 of the valid numbers.
    Values that are no whole numbers have no numeric statistics. A null load is a load. An empty table has no rows here.
    With n rows, n * high^4 must stay below 10^38; beyond, Spark raises an overflow error rather than rounding.
    """
    counts = materialise(histogram(df, load, columns, patterns), "histogram")
    stats = _statistics(low, high)
    by_load = counts.groupBy("load", "column_name").agg(*stats).withColumn("overall", F.lit(False))
    merged = counts.groupBy("column_name", "value", "digested", "broken").agg(F.sum("n").alias("n"))
    overall = merged.groupBy("column_name").agg(*stats).withColumn("overall", F.lit(True))
    overall = overall.withColumn("load", F.lit(None).cast(df.schema[load].dataType))
    return by_load.unionByName(overall.select(by_load.columns))


def beside_column(profile: DataFrame) -> DataFrame:
    """Each load's profile with its column's overall figures, prefixed `c_`; the overall side has one row per column."""
    names = [c for c in profile.columns if c not in ("load", "column_name", "overall")]
    overall = profile.where("overall").select("column_name", *[F.col(c).alias(f"c_{c}") for c in names])
    return profile.where("not overall").join(F.broadcast(overall), "column_name")


def unusual_loads(profile: DataFrame, *, null_margin: float = 0.2, factor: int = 2) -> DataFrame:
    """(load, column_name, mark) for the loads that stand out; a load may have several marks.

    `nulls`: its null share is more than `null_margin` above the column's. `range`: it has values out of range. `shift`: the
    mean of its valid numbers is more than `factor` times, or less than 1/`factor` of, the column's (no valid numbers: no
    mark). `constant`: exactly one distinct non-null value.
    """
    d = lambda c: F.col(c).cast("decimal(20,0)")
    p = beside_column(profile)
    excess = (d("n_null") / d("n_rows") - d("c_n_null") / d("c_n_rows")).cast("double")
    mean, c_mean = F.col("s1").cast("double") / F.col("n_valid"), F.col("c_s1").cast("double") / F.col("c_n_valid")
    shifted = (F.col("n_valid") > 0) & F.when(F.col("n_valid") > 0, (mean > factor * c_mean) | (mean * factor < c_mean))
    marks = {"nulls": excess > null_margin, "range": F.col("n_outside") > 0, "shift": shifted, "constant": F.col("n_distinct") == 1}
    found = F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in marks.items()]), lambda m: m.isNotNull())
    return p.select("load", "column_name", F.explode(found).alias("mark"))


def shifts(profile: DataFrame) -> DataFrame:
    """Each load against the rest of its column: mean, standard deviation, skewness, excess kurtosis and the standardised difference.

    The rest's power sums are the column's less the load's. Figures that need more values than there are, or a spread of
    zero, are null.
    """
    p = beside_column(profile).where("c_n_valid > 0")
    x = lambda c: F.col(c).cast("double")
    n, rest = x("n_valid"), x("c_n_valid") - x("n_valid")
    ratio = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0.0)))
    mean, rest_mean = ratio(x("s1"), n), ratio(x("c_s1") - x("s1"), rest)
    var = ratio(x("s2"), n) - mean * mean
    rest_var = ratio(x("c_s2") - x("s2"), rest) - rest_mean * rest_mean
    third = ratio(x("s3"), n) - 3 * mean * ratio(x("s2"), n) + 2 * mean * mean * mean
    fourth = ratio(x("s4"), n) - 4 * mean * ratio(x("s3"), n) + 6 * mean * mean * ratio(x("s2"), n) - 3 * mean * mean * mean * mean
    spread = F.sqrt(F.greatest((var + rest_var) / 2, F.lit(0.0)))
    return p.select(
        "load", "column_name", F.round(mean, 6).alias("mean"), F.round(rest_mean, 6).alias("rest_mean"),
        F.round(F.sqrt(F.greatest(var, F.lit(0.0))), 6).alias("deviation"),
        F.round(F.when(var > 0, third / F.pow(F.greatest(var, F.lit(1e-300)), 1.5)), 4).alias("skewness"),
        F.round(F.when(var > 0, fourth / F.pow(F.greatest(var, F.lit(1e-150)), 2.0) - 3), 4).alias("kurtosis"),
        F.round(F.when(spread > 0, (mean - rest_mean) / F.nullif(spread, F.lit(0.0))), 6).alias("standardised_difference"),
    )
