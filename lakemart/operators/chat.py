"""Normalisation of replayed conversation items held as VARIANT."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_history(turns: DataFrame, item: str = "item") -> DataFrame:
    """Collapse replayed assistant messages to ``{role, content}``.

    An item of type "message" and role "assistant" collapses when its content
    is a string, or a list and the item has no ``id``; the text of a list's
    ``output_text`` parts is joined by newlines, other parts are dropped.  All
    other items stay as they are.  Adds ``collapsed``.
    """

    def field(name: str, kind: str):
        return F.try_variant_get(item, f"$.{name}", kind)

    content = field("content", "variant")
    shape = F.schema_of_variant(content)
    is_text = shape == "STRING"
    is_list = shape.startswith("ARRAY")
    texts = F.transform(
        F.filter(
            content.try_cast("array<variant>"),
            lambda part: F.try_variant_get(part, "$.type", "string") == "output_text",
        ),
        lambda part: F.coalesce(F.try_variant_get(part, "$.text", "string"), F.lit("")),
    )
    message = (field("type", "string") == "message") & (field("role", "string") == "assistant")
    collapse = F.coalesce(message & (is_text | (is_list & field("id", "variant").isNull())), F.lit(False))
    text = F.when(is_text, field("content", "string")).otherwise(F.array_join(texts, "\n"))
    easy = F.to_variant_object(F.struct(F.lit("assistant").alias("role"), text.alias("content")))
    return turns.withColumn("collapsed", collapse).withColumn(
        item, F.when(F.col("collapsed"), easy).otherwise(F.col(item))
    )
