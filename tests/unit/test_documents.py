import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.contracts import RAG_CHUNKS, names
from lakemart.functions.text import html_text
from lakemart.operators import chat, documents
from lakemart.sources.tables import TableSpec, publish, read_binary, write_table

PRODUCTS = (
    "product_id string, product_name string, category string, subcategory string, brand string, "
    "unit_price decimal(12,2), supplier_name string, product_segment string, launch_date date"
)


def test_product_document(spark):
    products = spark.createDataFrame(
        [
            ("P1", "Chair", "Home", "Seats", "Acme", Decimal("10.50"), "Bolt", "BUDGET", date(2024, 5, 1)),
            ("P2", None, None, None, None, None, None, None, None),
        ],
        PRODUCTS,
    )
    fact = spark.createDataFrame(
        [("t1", "P1", 2, Decimal("20.00")), ("t1", "P1", 1, Decimal("5.25")), ("t2", "P1", 1, Decimal("1.00"))],
        "transaction_id string, product_id string, quantity int, net_sales_amount decimal(14,2)",
    )
    out = documents.product_documents(products, documents.product_sales_summary(fact))
    made = {r.document_id: r for r in out.collect()}
    assert made["product_P1"].content.split("\n") == [
        "Product ID: P1", "Product Name: Chair", "Category: Home", "Subcategory: Seats", "Brand: Acme",
        "Unit Price: 10.50", "Supplier: Bolt", "Product Segment: BUDGET", "Launch Date: 2024-05-01",
        "Total Units Sold: 4", "Total Net Sales: 26.25", "Transaction Count: 2",
    ]
    unsold = made["product_P2"].content.split("\n")
    assert unsold[1] == "Product Name: Unknown" and unsold[-2:] == ["Total Net Sales: 0.00", "Transaction Count: 0"]
    assert (made["product_P2"].document_type, made["product_P2"].source) == ("product", "gold.dim_product")


def texts(spark, *contents):
    rows = [(f"d{i}", "text", "s", c) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "document_id string, document_type string, source string, content string")


@pytest.mark.parametrize("n, size, overlap", [(0, 5, 2), (1, 5, 2), (5, 5, 2), (6, 5, 2), (8, 5, 2), (9, 5, 0), (57, 5, 4)])
def test_windows_cover_every_word(spark, n, size, overlap):
    words = [f"w{i}" for i in range(n)]
    docs = texts(spark, "  " + " \n".join(words) + "\t")
    got = [tuple(r) for r in documents.chunk(docs, size, overlap).orderBy("chunk_position").select(
        "chunk_id", "chunk_position", "chunk_to_retrieve", "metadata").collect()]
    starts = [0] if n else []
    while starts and starts[-1] + size < n:
        starts.append(starts[-1] + size - overlap)
    want = [
        (f"d0_{i}", i, " ".join(words[s : s + size]), json.dumps({"chunks": len(starts), "start_word": s}, separators=(",", ":")))
        for i, s in enumerate(starts)
    ]
    assert got == want


def test_variant_path_gives_the_same_chunks(spark):
    docs = texts(spark, " ".join(map(str, range(300))), "", "one").withColumn("category", F.lit("Home"))
    direct = documents.chunk(docs, 20, 5)
    through = documents.explode_prepared(documents.prepare(docs, 20, 5))
    assert dict(documents.prepare(docs).dtypes)["result"] == "variant"
    assert sorted(map(str, direct.collect())) == sorted(map(str, through.collect()))
    assert direct.head().chunk_to_embed.startswith("Home: 0 1")


def test_chunk_rows_do_not_carry_the_words(spark):
    docs = spark.createDataFrame([("d", "t", "s", "one two three")], ", ".join(f"{c} string" for c in ("document_id", "document_type", "source", "content")))
    plan = documents.chunk(docs, 2, 1)._jdf.queryExecution().optimizedPlan().toString()
    # The words are the fourth column in front of the generator, which drops it.
    assert "[3], true, [_no" in plan


def test_combined_sources(spark):
    a = documents.chunk(texts(spark, "x y"))
    b = documents.chunk(texts(spark, "z").withColumns({"product_id": F.lit("P1"), "category": F.lit("Home"), "product_segment": F.lit("BUDGET")}))
    out = documents.combine(a, b)
    assert tuple(out.columns) == names(RAG_CHUNKS)
    assert {(r.chunk_to_retrieve, r.category) for r in out.collect()} == {("x y", None), ("z", "Home")}
    assert documents.combine(a).head().product_segment is None


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        documents.chunk(texts(spark, "x"), 5, 5)


def test_page_text(spark):
    html = (
        "<html><head><title>T</title><STYLE>p{}</style><script>var a='</p>';</script></head><body><nav>menu</nav>"
        "<!-- c --><p>one&nbsp;&amp;lt;  two</p>\n<footer>f</footer><b>3&#39;s</b></body></html>"
    )
    assert spark.range(1).select(html_text(F.lit(html))).head()[0] == "T one &lt; two 3's"


def test_files_to_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.html").write_text("<p>é one</p>", encoding="utf-8")
    (tmp_path / "sub" / "b.html").write_text("<p>two</p>")
    (tmp_path / "c.txt").write_text("no")
    files = read_binary(spark, str(tmp_path), "*.html")
    assert files.columns == ["path", "content"]
    out = documents.file_documents(files).collect()
    assert sorted(r.content for r in out) == ["two", "é one"]


def test_tables_are_replaced_and_published(spark, tmp_path):
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    write_table(spark.range(3), first)
    spec = TableSpec("pub_test", "it's a test", {"layer": "gold"})
    publish(spark, spec, first)
    assert spark.table("pub_test").count() == 3
    write_table(spark.range(2).selectExpr("id", "'x' as extra"), second)
    publish(spark, spec, second)
    assert spark.table("pub_test").columns == ["id", "extra"] and spark.table("pub_test").count() == 2
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED pub_test").collect()}
    assert described["Comment"] == "it's a test" and "layer=gold" in described["Table Properties"]
    assert spark.read.parquet(first).count() == 3
    spark.sql("DROP VIEW pub_test")
    publish(spark, spec, second, {"extra": "upper(extra)"}, "id > 0")
    assert [tuple(r) for r in spark.table("pub_test").collect()] == [(1, "X")]
    with pytest.raises(ValueError, match="no columns"):
        publish(spark, spec, second, {"phone": "'*'"})
    spark.sql("DROP VIEW pub_test")


@pytest.mark.parametrize(
    "item, want",
    [
        ({"role": "user", "content": "q"}, None),
        ({"role": "assistant", "content": "plain"}, None),
        ({"type": "message", "role": "assistant", "content": "text"}, "text"),
        ({"id": "m", "type": "message", "role": "assistant", "content": "text"}, "text"),
        (
            {"type": "message", "role": "assistant", "content": [
                {"type": "output_text", "text": "a"}, {"type": "image", "text": "no"}, {"type": "output_text"}, "loose",
                {"type": "output_text", "text": "b"}]},
            "a\n\nb",
        ),
        ({"type": "message", "role": "assistant", "content": []}, ""),
        ({"id": "m", "type": "message", "role": "assistant", "content": [{"type": "output_text", "text": "a"}]}, None),
        ({"type": "message", "role": "assistant", "content": {"a": 1}}, None),
        ({"type": "message", "role": "user", "content": "text"}, None),
        ({"type": "call", "name": "f"}, None),
    ],
)
def test_history(spark, item, want):
    df = spark.createDataFrame([(json.dumps(item),)], "j string").select(F.parse_json("j").alias("item"))
    row = chat.normalize_history(df).select(F.to_json("item").alias("j"), "collapsed").head()
    assert row.collapsed == (want is not None)
    assert json.loads(row.j) == (item if want is None else {"role": "assistant", "content": want})
