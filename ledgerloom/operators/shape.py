"""Column sets, mappings and row filters used by every channel job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.numbers import NUMBER


def rename_by_map(df: DataFrame, mapping: Mapping[str, str | None]) -> DataFrame:
    """Rename by dictionary after trimming header names; a ``None`` target drops the column.

    Columns the dictionary does not mention are kept.
    """
    picked = []
    for name in df.columns:
        target = mapping.get(name.strip(), name.strip())
        if target is not None:
            picked.append(F.col(f"`{name}`").alias(target))
    return df.select(*picked)


def drop_columns(df: DataFrame, names: Iterable[str] = (), prefixes: Iterable[str] = ()) -> DataFrame:
    """Drop personal or year-to-date columns by name or by case-insensitive prefix."""
    unwanted = {n.lower() for n in names}
    starts = tuple(p.lower() for p in prefixes)
    keep = [
        c
        for c in df.columns
        if c.strip().lower() not in unwanted and not (starts and c.strip().lower().startswith(starts))
    ]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_target(df: DataFrame, schema: StructType | str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the target columns (a schema or its DDL) in order; a missing column or NULL cell takes its default."""
    defaults = defaults or {}
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def map_codes(code: Column, mapping: Mapping[str, str]) -> Column:
    """Look a code up in a fixed table; unknown codes are NULL."""
    table = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, code)


def unmapped_codes(df: DataFrame, code: str, mapping: Mapping[str, str]) -> DataFrame:
    """Distinct codes without a mapping."""
    known = F.col(code).isin(*mapping) if mapping else F.lit(False)
    return df.where(F.col(code).isNotNull() & ~known).select(code).distinct()


def fill_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL cells take the default; a column that is absent is created."""
    for name, value in defaults.items():
        current = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        df = df.withColumn(name, current)
    return df


def drop_null_dates(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Rows that have a date.  ``dropped_null_dates`` counts the others."""
    return df.where(F.col(date).isNotNull())


def dropped_null_dates(df: DataFrame, date: str = "sale_date", by: str | None = None) -> DataFrame:
    keys = [by] if by else []
    return df.groupBy(*keys).agg(
        F.count_if(F.col(date).isNotNull()).alias("kept"),
        F.count_if(F.col(date).isNull()).alias("dropped"),
    )


def filter_positive(df: DataFrame, amount: str) -> DataFrame:
    return df.where(F.col(amount) > 0)


def drop_blank_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows in which every cell is NULL."""
    return df.dropna(how="all", subset=cols)


def date_filter(df: DataFrame, start=None, end=None, date: str = "sale_date") -> DataFrame:
    """Inclusive date range; either end may be open."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    return df


def exclude_channels(df: DataFrame, names: Iterable[str], channel: str = "channel") -> DataFrame:
    """Hide the chosen channels."""
    names = list(names)
    return df.where(~F.col(channel).isin(*names)) if names else df


def channel_by_pattern(source: Column, pattern: str, hit: str, miss: str) -> Column:
    """Split one fact into two channels by a case-insensitive LIKE; NULL sources belong to neither."""
    return F.when(source.ilike(pattern), hit).when(~source.ilike(pattern), miss)


def select_subtotals(df: DataFrame, kind: str, earner: str, prefix: str = "ACX-") -> DataFrame:
    """Only the subtotal rows; the identifier is the earner text without its prefix."""
    return df.where(F.col(kind) == "Subtotal").withColumn(
        "book_identifier", F.replace(F.col(earner), F.lit(prefix), F.lit(""))
    )


def unpivot_crosstab(
    df: DataFrame,
    ids: list[str],
    value_columns: Iterable[str],
    variable: str = "region",
    value: str = "royalty_amount",
) -> DataFrame:
    """Cross-tab columns to rows, using the value columns that exist and keeping positive amounts."""
    present = [c for c in value_columns if c in df.columns]
    amounts = df.select(*ids, *[F.col(c).try_cast(NUMBER).alias(c) for c in present])
    return filter_positive(amounts.unpivot(ids, present, variable, value), value)
