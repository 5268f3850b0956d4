"""Documents from products and pages, and their search chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.contracts import RAG_CHUNKS
from lakemart.functions.columns import UNKNOWN, conform, project
from lakemart.functions.text import html_text, words

# Lines of a product document, label and column.
PRODUCT_LINES = (
    ("Product ID", "product_id"),
    ("Product Name", "product_name"),
    ("Category", "category"),
    ("Subcategory", "subcategory"),
    ("Brand", "brand"),
    ("Unit Price", "unit_price"),
    ("Supplier", "supplier_name"),
    ("Product Segment", "product_segment"),
    ("Launch Date", "launch_date"),
    ("Total Units Sold", "total_units_sold"),
    ("Total Net Sales", "total_net_sales"),
    ("Transaction Count", "transaction_count"),
)
TOTALS = ("total_units_sold", "total_net_sales", "transaction_count")


def product_sales_summary(fact_sales: DataFrame) -> DataFrame:
    """Units, net sales and number of sales per product."""
    return fact_sales.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        F.sum("net_sales_amount").alias("total_net_sales"),
        F.countDistinct("transaction_id").alias("transaction_count"),
    )


def product_documents(dim_product: DataFrame, summary: DataFrame) -> DataFrame:
    """One labelled text per product; a product never sold shows zeros."""
    known = dim_product.join(summary, "product_id", "left").na.fill(0, list(TOTALS))

    def line(label: str, column: str) -> Column:
        shown = F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
        return F.concat(F.lit(f"{label}: "), shown)

    return project(
        known,
        document_id=F.concat(F.lit("product_"), F.col("product_id")),
        document_type=F.lit("product"),
        source=F.lit("gold.dim_product"),
        product_id=F.col("product_id"),
        category=F.col("category"),
        product_segment=F.col("product_segment"),
        content=F.concat_ws("\n", *(line(*p) for p in PRODUCT_LINES)),
    )


def page_documents(pages: DataFrame) -> DataFrame:
    """One text per web page; its address identifies it."""
    return project(
        pages,
        document_id=F.concat(F.lit("page_"), F.sha2(F.col("url"), 256)),
        document_type=F.lit("page"),
        source=F.col("url"),
        content=html_text(F.col("html")),
    )


def file_documents(files: DataFrame) -> DataFrame:
    """Like :func:`page_documents` for files scanned as (path, content) bytes."""
    return page_documents(
        files.select(F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"))
    )


def text_documents(documents: DataFrame) -> DataFrame:
    """One document per row of a table (doc_id, source, text)."""
    return project(
        documents,
        document_id=F.concat(F.lit("text_"), F.col("doc_id")),
        document_type=F.lit("text"),
        source=F.col("source"),
        content=F.col("text"),
    )


class _Windows:
    """Overlapping windows over a column ``_words``, covering all of it."""

    def __init__(self, docs: DataFrame, size: int, overlap: int):
        if not 0 <= overlap < size:
            raise ValueError("the overlap must be smaller than the window")
        # The words are a column of their own, so each text is split once.
        self.docs = docs.withColumn("_words", words(F.col("content")))
        self.size, self.step = size, size - overlap
        self.category = F.col("category") if "category" in docs.columns else F.lit(None).cast("string")

    def count(self) -> Column:
        n = F.size("_words")
        more = F.ceil((n - self.size) / F.lit(float(self.step))).cast("int")
        return F.when(n == 0, F.lit(0)).otherwise(F.greatest(more, F.lit(0)) + 1)

    def starts(self) -> Column:
        """First word of every window; NULL for a text without words."""
        last = (self.count() - 1) * self.step
        return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(self.step)))

    def text(self, at: Column) -> Column:
        return F.array_join(F.slice("_words", at + 1, F.lit(self.size)), " ")

    def fields(self, position: Column, at: Column, text: Column, count: Column) -> dict[str, Column]:
        return {
            "chunk_position": position,
            "chunk_to_retrieve": text,
            "chunk_to_embed": F.concat_ws(": ", self.category, text),
            "metadata": F.to_json(F.struct(count.alias("chunks"), at.alias("start_word"))),
        }


def chunk(docs: DataFrame, size: int = 120, overlap: int = 20) -> DataFrame:
    """One row per word window of every document, in the chunk table's columns."""
    w = _Windows(docs, size, overlap)
    pieces = F.transform(w.starts(), lambda at: F.struct(at.alias("at"), w.text(at).alias("text")))
    # Finished texts are exploded: with the words in them, the rows of one
    # document would grow with the square of its length.  The outer form: the
    # inner one would derive a filter that splits the text a second time.
    counted = w.docs.withColumn("_count", w.count())
    placed = counted.select("*", F.posexplode_outer(pieces).alias("_no", "_piece")).filter("_piece IS NOT NULL")
    fields = w.fields(F.col("_no"), F.col("_piece.at"), F.col("_piece.text"), F.col("_count"))
    return _chunk_rows(placed.withColumns(fields))


def prepare(docs: DataFrame, size: int = 120, overlap: int = 20) -> DataFrame:
    """Add ``result``: the chunks of ``content`` as one VARIANT per document.

    Its shape is ``document.contents[*]`` with chunk_position,
    chunk_to_retrieve, chunk_to_embed and metadata.
    """
    w = _Windows(docs, size, overlap)
    contents = F.transform(
        w.starts(),
        lambda at, i: F.struct(*(c.alias(n) for n, c in w.fields(i, at, w.text(at), w.count()).items())),
    )
    shape = F.struct(F.struct(contents.alias("contents")).alias("document"))
    return w.docs.withColumn("result", F.to_variant_object(shape)).drop("_words")


OPTIONAL = ("product_id", "category", "product_segment")


def _chunk_rows(pieces: DataFrame) -> DataFrame:
    return project(
        pieces,
        chunk_id=F.concat_ws("_", "document_id", F.col("chunk_position").cast("string")),
        chunk_position=F.col("chunk_position"),
        chunk_to_retrieve=F.col("chunk_to_retrieve"),
        chunk_to_embed=F.col("chunk_to_embed"),
        metadata=F.col("metadata"),
        source_uri=F.col("source"),
        document_type=F.col("document_type"),
        **{c: F.col(c) for c in OPTIONAL if c in pieces.columns},
    )


def explode_prepared(prepared: DataFrame) -> DataFrame:
    """One row per chunk of a VARIANT ``result`` (see :func:`prepare`)."""
    kept = [c for c in prepared.columns if c != "result"]
    pieces = prepared.sparkSession.sql(
        f"""
        SELECT {", ".join(kept)},
               variant_get(chunk.value, '$.chunk_position', 'int') AS chunk_position,
               variant_get(chunk.value, '$.chunk_to_retrieve', 'string') AS chunk_to_retrieve,
               variant_get(chunk.value, '$.chunk_to_embed', 'string') AS chunk_to_embed,
               variant_get(chunk.value, '$.metadata', 'string') AS metadata
        FROM {{prepared}} p, LATERAL variant_explode(variant_get(p.result, '$.document.contents')) AS chunk
        """,
        prepared=prepared.select(*kept, "result"),
    )
    return _chunk_rows(pieces)


def combine(*sources: DataFrame) -> DataFrame:
    """One chunk table from several sources; columns a source lacks are NULL."""
    out = sources[0]
    for more in sources[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL if c not in out.columns}
    return conform(out.withColumns(absent) if absent else out, RAG_CHUNKS)
