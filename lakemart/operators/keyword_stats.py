"""Keyword statistics that follow a chunk table without counting it again.

The statistics are one table of sums, (statistic, term, value): the number of
documents, the number of their words, and for every term the number of documents
that hold it.  A change of the chunk table is a table of the same form with signs, so
keeping up means adding, and what adds up to nothing vanishes.

A NULL text is no document; an empty one is a document without words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import terms
from lakemart.operators.cdc import signed_changes

DOCUMENTS, WORDS, FREQUENCY = "documents", "words", "document_frequency"


def signed_statistics(rows: DataFrame, text: str, sign: Column | str) -> DataFrame:
    """(statistic, term, value) of rows that come (sign 1) and go (sign -1)."""
    each = rows.where(F.col(text).isNotNull()).select(terms(F.col(text)).alias("_terms"), F.col(sign).alias("_sign") if isinstance(sign, str) else sign.alias("_sign"))
    none = F.lit(None).cast("string")

    def line(statistic: str, term: Column, value: Column) -> Column:
        return F.struct(F.lit(statistic).alias("statistic"), term.alias("term"), value.cast("long").alias("value"))

    totals = F.array(line(DOCUMENTS, none, F.lit(1)), line(WORDS, none, F.size("_terms")))
    found = F.transform(F.array_distinct("_terms"), lambda t: line(FREQUENCY, t, F.lit(1)))
    lines = each.select("_sign", F.explode(F.concat(totals, found)).alias("line"))
    return _added(lines.select("line.statistic", "line.term", (F.col("line.value") * F.col("_sign")).alias("value")))


def _added(lines: DataFrame) -> DataFrame:
    return lines.groupBy("statistic", "term").agg(F.sum("value").alias("value")).where(F.col("value") != 0)


def statistics(docs: DataFrame, text: str = "chunk_to_retrieve") -> DataFrame:
    """The statistics of a whole table, counted from scratch."""
    return signed_statistics(docs, text, F.lit(1))


def sync_statistics(known: DataFrame, old: DataFrame, new: DataFrame, key: str = "chunk_id", text: str = "chunk_to_retrieve") -> DataFrame:
    """``known``, the statistics of ``old``, brought up to ``new``.

    Only rows that differ are split into words.  Give written tables: the
    difference reads them more than once.
    """
    changes = signed_changes(old.select(key, text), new.select(key, text), key)
    return _added(known.unionByName(signed_statistics(changes, text, "sign")))
