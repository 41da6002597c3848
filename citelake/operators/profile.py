"""Eleven statistics per column, over a whole table or by group, as one aggregation and a small pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.functions.text import number_or_null, safe_mean

# The statistics by name.
STATISTICS = ["count", "count_non_zero", "count_numeric", "count_valid", "count_zero", "max", "mean", "mean_non_zero", "min", "sum", "type"]
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _as_number(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, NUMERIC):
        return c.cast("double")
    if isinstance(field.dataType, T.BooleanType):
        return c.cast("int").cast("double")
    return number_or_null(c.cast("string"))


def profile_long(df: DataFrame, by: list[str] | None = None, na_tokens: list[str] | None = None) -> DataFrame:
    """One row per group and column with the statistics as typed columns.

    A column is `numeric` in a group if it has a value there and every value reads as a number (booleans as 1 and 0), else
    `str`, without numeric statistics; a column without rows has no type. A null group key is reported as `''`. Texts in
    `na_tokens` count as null.
    """
    by = by or []
    if clash := ({"column_name", "value_type", *STATISTICS} - {"type"}) & set(by):
        raise ValueError(f"rename the group columns {sorted(clash)}; statistics have these names")
    columns = [f for f in df.schema.fields if f.name not in by]
    if na_tokens:
        df = df.withColumns({f.name: F.when(~F.col(f"`{f.name}`").isin(na_tokens), F.col(f"`{f.name}`")) for f in columns if isinstance(f.dataType, T.StringType)})
    keys = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in by]
    # Numbers are made once, in a projection below the aggregation.
    cells = df.select(*keys, *[F.col(f"`{f.name}`").isNotNull().alias(f"v{i}") for i, f in enumerate(columns)], *[_as_number(f).alias(f"x{i}") for i, f in enumerate(columns)])
    aggs = [F.count("*").alias("n")]
    for i in range(len(columns)):
        x = F.col(f"x{i}")
        aggs += [
            F.count_if(f"v{i}").alias(f"valid{i}"), F.count(x).alias(f"numeric{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
            F.sum(x).alias(f"sum{i}"), F.count_if(x != 0).alias(f"nonzero{i}"),
        ]
    wide = cells.groupBy(*by).agg(*aggs)

    def one(i: int, name: str) -> Column:
        g = lambda s: F.col(f"{s}{i}")
        numeric = (g("valid") > 0) & (g("valid") == g("numeric"))
        when = lambda c: F.when(numeric, c)
        return F.struct(
            F.lit(name).alias("column_name"), F.col("n").alias("count"), g("valid").alias("count_valid"),
            F.when(F.col("n") > 0, F.when(numeric, "numeric").otherwise("str")).alias("value_type"),
            when(g("min")).alias("min"), when(g("max")).alias("max"), when(g("sum")).alias("sum"), when(g("numeric")).alias("count_numeric"),
            when(g("nonzero")).alias("count_non_zero"), when(g("numeric") - g("nonzero")).alias("count_zero"),
            when(g("sum") / F.nullif(g("numeric"), F.lit(0))).alias("mean"), when(safe_mean(g("sum"), g("nonzero"))).alias("mean_non_zero"),
        )

    return wide.select(*by, F.inline(F.array(*[one(i, f.name) for i, f in enumerate(columns)])))


def _text(c: Column, kind: str) -> Column:
    """A number as the shortest text: whole ones without a decimal point."""
    if kind == "text":
        return c
    return F.when(c == F.floor(c), F.coalesce(c.try_cast("decimal(38,0)").cast("string"), c.cast("string"))).otherwise(c.cast("string")) if kind == "double" else c.cast("string")


def profile(df: DataFrame, by: list[str] | None = None, na_tokens: list[str] | None = None) -> DataFrame:
    """The profile as a matrix: a row per group and statistic that any column has, a text cell per profiled column."""
    by = by or []
    names = [c for c in df.columns if c not in by]
    kinds = {"type": "text", "count": "bigint", "count_valid": "bigint", "count_numeric": "bigint", "count_non_zero": "bigint", "count_zero": "bigint"}
    long = profile_long(df, by, na_tokens)
    cells = F.array(*[F.struct(F.lit(s).alias("stat"), _text(F.col("value_type" if s == "type" else s), kinds.get(s, "double")).alias("cell")) for s in STATISTICS])
    rows = long.select(*by, "column_name", F.inline(cells)).where("cell is not null")
    return rows.groupBy(*by, "stat").pivot("column_name", names).agg(F.first("cell")).orderBy(*by, "stat")


def from_matrix(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The numbers of a long profile from its matrix as it was written (all text): rows of `type` are dropped, cells that are no numbers become NULL."""
    by = by or []
    names = [c for c in rows.columns if c not in (*by, "stat")]
    keys = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in by]
    long = rows.where("stat <> 'type'").select(*keys, "stat", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("cell")) for c in names])))
    numbers = [s for s in STATISTICS if s != "type"]
    value = {s: F.max(F.when(F.col("stat") == s, number_or_null(F.col("cell")))) for s in numbers}
    return long.groupBy(*by, "column_name").agg(*[(v.cast("bigint") if s.startswith("count") else v).alias(s) for s, v in value.items()])


def merge_profiles(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The long profile of two tables together, from their long profiles; `value_type` stays numeric only where both are."""
    by = by or []
    both = a.unionByName(b)
    text = F.max((F.col("value_type") == "str") & (F.col("count_valid") > 0))
    out = both.groupBy(*by, "column_name").agg(
        F.sum("count").alias("count"), F.sum("count_valid").alias("count_valid"), text.alias("_text"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("sum").alias("sum"), F.sum("count_numeric").alias("count_numeric"), F.sum("count_non_zero").alias("count_non_zero"), F.sum("count_zero").alias("count_zero"),
    )
    numeric = ~F.coalesce("_text", F.lit(False)) & (F.col("count_valid") > 0)
    kept = {c: F.when(numeric, F.col(c)) for c in ("min", "max", "sum", "count_numeric", "count_non_zero", "count_zero")}
    out = out.withColumn("value_type", F.when(F.col("count") > 0, F.when(numeric, "numeric").otherwise("str"))).withColumns(kept)
    out = out.withColumns({"mean": F.col("sum") / F.nullif(F.col("count_numeric"), F.lit(0)), "mean_non_zero": F.when(numeric, safe_mean(F.col("sum"), F.col("count_non_zero")))})
    return out.select(a.columns)
