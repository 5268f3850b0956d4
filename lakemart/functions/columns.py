"""Small Column builders shared by the table builders.

Everything here is a built-in expression, so it stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Text forms of the source systems.
SOURCE_TIMESTAMP = "dd-MMM-yyyy hh.mm.ss a"
DATE_KEY = "yyyyMMdd"
UNKNOWN = "Unknown"


def project(df: DataFrame, **columns: Column) -> DataFrame:
    """One ``select`` naming every output column by its keyword."""
    return df.select(*(expr.alias(name) for name, expr in columns.items()))


def text(name: str) -> Column:
    return F.trim(F.col(name))


def code(name: str) -> Column:
    """Identifiers compare without case or outer blanks."""
    return F.upper(text(name))


def title(name: str) -> Column:
    return F.initcap(text(name))


def title_or_unknown(name: str) -> Column:
    return F.coalesce(title(name), F.lit(UNKNOWN))


def whole(name: str, strict: bool = False) -> Column:
    """Integer; unreadable text becomes NULL unless ``strict``."""
    source = F.col(name)
    return source.cast("int") if strict else source.try_cast("int")


def money(source: Column, precision: int, strict: bool = False) -> Column:
    """Decimal with two places; out of range becomes NULL unless ``strict``."""
    kind = f"decimal({precision},2)"
    return source.cast(kind) if strict else source.try_cast(kind)


def moment(name: str, strict: bool = False) -> Column:
    """Timestamp in the source systems' twelve-hour text form."""
    pattern = F.lit(SOURCE_TIMESTAMP)
    if strict:
        return F.to_timestamp(F.col(name), SOURCE_TIMESTAMP)
    return F.try_to_timestamp(text(name), pattern)


def date_key(source: Column) -> Column:
    """A date as the integer yyyymmdd, computed without going through text."""
    return F.year(source) * 10000 + F.month(source) * 100 + F.dayofmonth(source)


def match_key(name: str) -> Column:
    """Join key for free-text names."""
    return F.upper(F.trim(F.col(name)))


def ladder(steps: list[tuple[Column, str]], otherwise: str) -> Column:
    """First label whose condition holds; NULL conditions fall through."""
    chain = F
    for condition, label in steps:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def is_blank(source: Column) -> Column:
    return source.isNull() | (F.trim(source.cast("string")) == "")


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast and order columns to a declared schema, and check the result."""
    wanted = StructType.fromDDL(ddl)
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")
    out = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))
    got = [(f.name, f.dataType) for f in out.schema]
    if got != [(f.name, f.dataType) for f in wanted]:
        raise ValueError(f"schema differs from the declared one: {got}")
    return out
