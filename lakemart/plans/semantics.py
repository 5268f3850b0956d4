"""Semantic model of the star schema: joins, measure, question to DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import contracts
from lakemart.operators import gold
from lakemart.operators.gates import GateFailed, Star


@dataclass(frozen=True)
class Measure:
    """A sum over a fact column; sums of sums are the sum, so it may be
    aggregated before the joins."""

    name: str
    column: str
    synonyms: tuple[str, ...] = ()
    money: bool = True


@dataclass(frozen=True)
class Model:
    # Many-to-one joins (dimension -> key on both sides).
    joins: Mapping[str, str] = field(
        default_factory=lambda: {
            "dim_customer": "customer_id",
            "dim_product": "product_id",
            "dim_date": "date_key",
        }
    )
    # The measure and the words that mean it.
    measures: tuple[Measure, ...] = (
        Measure(
            "total_net_sales",
            "net_sales_amount",
            ("net sales", "total net sales", "sales", "total sales", "sales amount", "revenue"),
        ),
    )
    # Columns whose values people name in questions.
    entity_columns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "dim_date": ("day_name", "month_name", "month_year", "quarter_name"),
            "dim_product": (
                "brand", "category", "product_name",
                "product_segment", "subcategory", "supplier_name",
            ),
            "fact_sales": ("payment_mode", "sales_channel"),
        }
    )

    # Columns of each table, known without planning the table.
    columns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "fact_sales": contracts.names(contracts.FACT_SALES),
            "dim_customer": contracts.names(contracts.DIM_CUSTOMER),
            "dim_product": contracts.names(contracts.DIM_PRODUCT),
            "dim_date": contracts.names(contracts.DIM_DATE),
        }
    )

    def home(self, column: str) -> str:
        """The table a column is taken from; the fact comes first."""
        for table, columns in self.columns.items():
            if column in columns:
                return table
        raise KeyError(f"no table of the model has a column {column!r}")

    def measure(self, word: str) -> Measure:
        wanted = " ".join(word.lower().replace("_", " ").split())
        for m in self.measures:
            if wanted in (m.name.replace("_", " "), *m.synonyms):
                return m
        raise KeyError(f"no measure is called {word!r}")


MODEL = Model()


def star_query(
    star: Star,
    dims: Sequence[str],
    measure: str = "net sales",
    filters: Mapping[str, object] | None = None,
    order: str | None = "measure",
    limit: int | None = None,
    model: Model = MODEL,
) -> DataFrame:
    """Measure by dimension columns, joining only the dimensions it needs.

    ``dims`` and the keys of ``filters`` are column names of the fact or of a
    dimension; a filter value is one value or a list.  The fact is summed per
    needed key before any join, so a join sees one row per key instead of one
    per sale.  ``order``: "measure" (descending), "dims" (ascending, for
    trends) or None.

    Where the star's calendar follows its sales, the calendar's columns are
    worked out from the date keys of the sums, and no calendar is built.
    """
    m = model.measure(measure)
    filters = dict(filters or {})
    found = {c: model.home(c) for c in [*dims, *filters]}
    homes = {c: table for c, table in found.items() if table != "fact_sales"}

    def matches(column: str) -> Column:
        value = filters[column]
        return F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == value

    facts = star.fact_sales
    for column in filters:
        if column not in homes:
            facts = facts.filter(matches(column))
    needed = [d for d in model.joins if d in homes.values()]
    local = [c for c in dims if c not in homes]
    keys = list(dict.fromkeys([*(model.joins[d] for d in needed), *local]))
    summed = facts.groupBy(*keys).agg(F.sum(m.column).alias("_part"))

    for dim in needed:
        columns = [c for c, home in homes.items() if home == dim]
        if dim == "dim_date" and getattr(star, "calendar_follows_sales", False):
            worked_out = gold.calendar_columns(gold.day_of_key(F.col(model.joins[dim])))
            summed = summed.where(F.col(model.joins[dim]).isNotNull()).withColumns({c: worked_out[c] for c in columns if c != model.joins[dim]})
            for column in columns:
                if column in filters:
                    summed = summed.filter(matches(column))
            continue
        side = getattr(star, dim)
        for column in columns:
            if column in filters:
                side = side.filter(matches(column))
        side = side.select(model.joins[dim], *(c for c in dict.fromkeys(columns) if c in dims))
        summed = summed.join(side, model.joins[dim])

    result = summed.groupBy(*dims).agg(F.sum("_part").alias(m.name))
    if m.money:
        result = result.withColumn(m.name, F.round(m.name, 2).cast("decimal(28,2)"))
    if order is None and limit is None:
        return result
    by_name = [F.col(c) for c in dims]
    ranking = by_name if order == "dims" else [F.col(m.name).desc_nulls_last(), *by_name]
    result = result.orderBy(*ranking)
    return result.limit(limit) if limit else result


def check_many_to_one(star: Star, model: Model = MODEL) -> None:
    """Stop if a declared join could repeat fact rows."""
    for dim, key in model.joins.items():
        table = getattr(star, dim)
        row = table.agg((F.count(key) - F.countDistinct(key)).alias("extra")).head()
        if row.extra:
            raise GateFailed(f"{dim}.{key} is not unique: {row.extra} extra rows")


def entity_values(star: Star, model: Model = MODEL) -> DataFrame:
    """(table_name, column_name, value, rows): the values questions may name."""
    parts = []
    for table, columns in model.entity_columns.items():
        frame = getattr(star, table)
        # One scan per table: every row offers its value of each column.
        pairs = F.array(
            *(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns)
        )
        parts.append(
            frame.select(F.inline(pairs))
            .filter("value IS NOT NULL")
            .groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table_name"), "column_name", "value", "rows")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
