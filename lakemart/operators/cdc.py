"""Change feeds: history and current state, deduplication, table difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.columns import is_blank


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark puts a group limit of one row in front of the shuffle, so a key that
    holds a third of the table sends one row per map task, not a third of it.
    """
    pick = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(pick)).filter("_rn = 1").drop("_rn")


def few_without_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows, but of those with an absent or blank key only the first of each key.

    They are the key that holds many rows, and all of them meet in one task where
    rows are dealt out by key.
    """
    blank = reduce(lambda a, b: a | b, (is_blank(F.col(k)) for k in keys))
    return df.filter(~blank).unionByName(first_per_key(df.filter(blank), keys, order))


def deduplicate(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    keep_null_keys: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Batch form of first-arrival deduplication, with a total order.

    All rows with a NULL key count as one, as in a streaming
    ``dropDuplicates``; ``keep_null_keys`` keeps each of them.

    ``pieces`` deals a large table by key to so many tasks before anything is sorted:
    the limit in front of the shuffle sorts whole rows by input piece, which for a
    table of few repeats costs memory and removes little.
    """
    first = [F.col(c).asc_nulls_first() for c in order]
    rows = df if not keep_null_keys else df.filter(F.col(key).isNotNull())
    if pieces:
        rows = few_without_key(rows, [key], first).repartition(pieces, key)
    ranked = first_per_key(rows, [key], first)
    return ranked.unionByName(df.filter(F.col(key).isNull())) if keep_null_keys else ranked


def current_state(feed: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op", pieces: int | None = None) -> DataFrame:
    """Latest version of each key; keys whose last change is a delete vanish.

    ``pieces`` deals the changes by key to so many tasks, for a feed too large for
    the session's number; a key's changes then meet in one task, all of them.
    """
    if pieces:
        feed = feed.repartition(pieces, *keys)
    rest = [c for c in feed.columns if c not in (*keys, seq)]
    last = first_per_key(feed, keys, [F.col(seq).desc(), *(F.col(c).desc_nulls_last() for c in rest)])
    return last.filter(F.col(op) != "D").drop(seq, op)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    chunk: str,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
) -> DataFrame:
    """Previous and next values along ``seq`` without one task per key.

    A plain window would sort a hot key's whole history in one task.  Here the
    window runs per (key, ``chunk``), a column that must not decrease with
    ``seq``; the values that cross a chunk edge come from a table with one row
    per (key, chunk), joined back on the partitioning the window already has.
    ``lag`` and ``lead`` map a new column name to its source column.
    """
    lag, lead = lag or {}, lead or {}
    inner = Window.partitionBy(*keys, chunk).orderBy(seq)
    across = Window.partitionBy(*keys).orderBy(chunk)

    def picked(columns: dict[str, str]) -> Column:
        return F.struct(*(F.col(c) for c in sorted({*columns.values()})))

    ends, edges = [], []
    if lead:
        ends.append(F.min_by(picked(lead), F.col(seq)).alias("_head"))
        edges.append(F.lead("_head").over(across).alias("_after"))
    if lag:
        ends.append(F.max_by(picked(lag), F.col(seq)).alias("_tail"))
        edges.append(F.lag("_tail").over(across).alias("_before"))
    crossing = df.groupBy(*keys, chunk).agg(*ends).select(*keys, chunk, *edges)

    inside = {"_first": F.lag(F.lit(True)).over(inner), "_last": F.lead(F.lit(True)).over(inner)}
    inside |= {f"_in_{n}": F.lag(c).over(inner) for n, c in lag.items()}
    inside |= {f"_in_{n}": F.lead(c).over(inner) for n, c in lead.items()}
    joined = df.withColumns(inside).join(crossing, [*keys, chunk])

    def value(edge: str, side: str, name: str, source: str) -> Column:
        return F.when(F.col(edge).isNull(), F.col(f"{side}.{source}")).otherwise(F.col(f"_in_{name}")).alias(name)

    return joined.select(
        *df.columns,
        *(value("_first", "_before", n, c) for n, c in lag.items()),
        *(value("_last", "_after", n, c) for n, c in lead.items()),
    )


def history(
    feed: DataFrame,
    keys: Sequence[str],
    seq: str = "seq",
    op: str = "op",
    track: Sequence[str] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Validity intervals (``__START_AT``, ``__END_AT``) from a change feed.

    ``chunk`` cuts a key's history into pieces of work, by default its days.
    Changes of one key at the same ``seq`` count once (the delete, else the
    greatest row).  A version equal to the one before it in the ``track``
    columns adds no row.  A delete closes the open interval and adds no row.
    """
    values = [c for c in feed.columns if c not in (*keys, seq, op)]
    track = list(track or values)
    chunk = F.date_trunc("day", F.col(seq)) if chunk is None else chunk

    keyed = F.lit(True)
    for k in keys:
        keyed &= F.col(k).isNotNull()

    # One shuffle by (key, chunk) serves every step below.
    part = feed.filter(keyed).withColumn("_chunk", chunk).repartition(*(F.col(k) for k in keys), F.col("_chunk"))
    once = first_per_key(
        part,
        [*keys, "_chunk", seq],
        [(F.col(op) == "D").desc(), *(F.col(c).desc_nulls_last() for c in (op, *values))],
    )
    # A fingerprint only decides equality of neighbours of one key.
    state = F.sha2(F.to_json(F.struct(*track), {"ignoreNullFields": "false"}), 256)
    marked = once.withColumn("_state", F.when(F.col(op) != "D", state).otherwise(F.lit("D")))
    changed = (
        with_neighbours(marked, keys, seq, "_chunk", lag={"_was": "_state"})
        .filter(~F.col("_state").eqNullSafe(F.col("_was")))
        .drop("_was")
    )
    closed = with_neighbours(changed, keys, seq, "_chunk", lead={"__END_AT": seq})
    # Rows without a key have no neighbours; they stay, for the quality rules.
    loose = feed.filter(~keyed).withColumn("__END_AT", F.lit(None).cast(feed.schema[seq].dataType))
    return (
        closed.drop("_state", "_chunk")
        .unionByName(loose)
        .filter(F.col(op) != "D")
        .withColumn("__START_AT", F.col(seq))
        .select(*keys, *values, "__START_AT", "__END_AT")
    )


# A table difference compares sums per bucket of keys before it compares keys.
BUCKETS = 4096


def digested(df: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows with ``_bucket``, the hash of their key, and ``_digest``, 128 bits over ``columns``.

    Text and NULLs are told apart: the row is digested as JSON with its NULL fields.
    """
    shown = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    return df.withColumns({"_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), "_digest": shown})


def unequal_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """(_bucket) of digested tables whose number of rows or sums of digests differ.

    At most one row per bucket, so the list is small whatever the tables' size.
    """

    def sums(df: DataFrame, name: str) -> DataFrame:
        halves = [F.sum(F.conv(F.substring("_digest", at, 16), 16, 10).cast("decimal(38,0)")) for at in (1, 17)]
        return df.groupBy("_bucket").agg(F.struct(F.count(F.lit(1)).alias("rows"), *(h.alias(f"half{i}") for i, h in enumerate(halves))).alias(name))

    both = sums(old, "_a").join(sums(new, "_b"), "_bucket", "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("_bucket")


def table_diff(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Row changes from ``old`` to ``new``: insert, update or delete per key.

    Returns the new row (the old one for deletes) with ``change_type``.  Keys are
    unique; a NULL key is a key like any other.

    Level by level: sums of row digests per bucket of keys (only sums are
    shuffled), then the digests of the keys in unequal buckets, then the rows
    of the changed keys.  Equal buckets are never joined, so tables that hardly
    differ cost two scans.  Both tables are read three times: give written ones.
    """
    columns = new.columns
    a, b = (digested(df.select(*columns), key, columns, buckets) for df in (old, new))
    unequal = unequal_buckets(a, b)
    left, right = (df.join(unequal, "_bucket", "left_semi") for df in (a, b))
    known = (left.select(F.col(key).alias("_ka"), F.col("_digest").alias("_da")), right.select(F.col(key).alias("_kb"), F.col("_digest").alias("_db")))
    kind = F.when(F.col("_da").isNull(), "insert").when(F.col("_db").isNull(), "delete").when(F.col("_da") != F.col("_db"), "update")
    keys = known[0].join(known[1], F.col("_ka").eqNullSafe(F.col("_kb")), "full").select(
        F.when(F.col("_db").isNull(), F.col("_ka")).otherwise(F.col("_kb")).alias("_key"), kind.alias("change_type")
    )
    keys = keys.where(F.col("change_type").isNotNull())

    def rows(df: DataFrame, wanted: Column) -> DataFrame:
        return df.join(keys.where(wanted), F.col(key).eqNullSafe(F.col("_key"))).select("change_type", *columns)

    deleted = F.col("change_type") == "delete"
    return rows(right, ~deleted).unionByName(rows(left, deleted))


def signed_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """What turns ``old`` into ``new``: rows to take out (sign -1) and to put in (sign 1).

    An update is both.  The form that sums kept up to date need.
    """
    changes = table_diff(old, new, key)
    gone = changes.where("change_type != 'insert'").select(F.col(key).alias("_key"))
    out = old.select(*new.columns).join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_semi").withColumn("sign", F.lit(-1))
    return out.unionByName(changes.where("change_type != 'delete'").drop("change_type").withColumn("sign", F.lit(1)))
