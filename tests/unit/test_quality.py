import pytest

from lakemart.operators import gates, quality
from lakemart.operators.quality import Rule

LONG = """
- name: id_given
  criticality: error
  check:
    function: is_not_null_and_not_empty
    arguments: {column: id, trim_strings: true}
- name: positive
  criticality: error
  check: {function: sql_expression, arguments: {expression: "n > 0"}}
- name: has_note
  criticality: warn
  check: {function: is_not_null, arguments: {column: note}}
"""


@pytest.fixture
def rules():
    import yaml

    return quality.parse_rules(yaml.safe_load(LONG))


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), (" ", 1, "x"), (None, -1, "x"), ("b", None, None), ("c", 0, None)],
        "id string, n int, note string",
    )


def test_every_row_is_on_one_side(rows, rules):
    valid, bad = quality.split(rows, rules)
    assert {r.id for r in valid.collect()} == {"a", "b"}
    assert valid.columns == rows.columns
    found = {(r.id, tuple(e.name for e in r._errors)) for r in bad.collect()}
    assert found == {(" ", ("id_given",)), (None, ("id_given", "positive")), ("c", ("positive",))}
    warned = {r.id: [w.name for w in r._warnings] for r in bad.collect()}
    assert warned["c"] == ["has_note"] and warned[" "] == []


def test_null_predicate_can_fail(rows, rules):
    valid, bad = quality.split(rows, rules, null_passes=False)
    assert {r.id for r in valid.collect()} == {"a"}
    assert bad.count() == 4


def test_parse_failures_are_errors(spark, rules):
    df = spark.createDataFrame(
        [("a", 1, "x", []), ("b", None, "x", ["n"])], "id string, n int, note string, parse_failures array<string>"
    )
    valid, bad = quality.split(df, rules)
    assert [r.id for r in valid.collect()] == ["a"] and "parse_failures" not in valid.columns
    assert [e.name for e in bad.head()._errors] == ["readable_values"]


def test_reasons(rows, rules):
    out = quality.reasons(quality.quarantined_rows(rows, rules), "id").collect()
    assert sorted((str(r.row_key), r.rule) for r in out) == [
        (" ", "id_given"), ("None", "id_given"), ("None", "positive"), ("c", "positive"),
    ]


@pytest.mark.parametrize(
    "rule, words",
    [
        (Rule("r", "looks_nice", {"column": "id"}), "unknown function"),
        (Rule("r", "is_not_null", {}), "missing argument"),
        (Rule("r", "is_not_null", {"column": "nope"}), "nope"),
        (Rule("r", "is_not_null", {"column": "id"}, "fatal"), "criticality"),
        (Rule("r", "sql_expression", {"expression": "n >"}), "r:"),
        (Rule("r", "sql_expression", {"expression": "n + 1"}), "r:"),
        (Rule("", "is_not_null", {"column": "id"}), "name is required"),
    ],
)
def test_defective_rules_are_named(spark, rows, rule, words):
    good = Rule("fine", "is_not_null", {"column": "id"})
    errors = quality.validate_rules(spark, [good, rule], rows.schema)
    assert len(errors) == 1 and words in errors[0]
    with pytest.raises(ValueError, match="invalid quality rules"):
        quality.split(rows, [good, rule])


def test_shipped_rule_and_expectation_counts():
    counts = {d: len(quality.load_rules(d)) for d in quality.DATASETS}
    assert counts == {"transactions": 9, "opportunity": 7, "inventory": 7, "product_catalog": 7, "account": 5}
    measured = {d: len(quality.load_expectations(d)) for d in quality.DATASETS}
    assert measured == {"transactions": 9, "inventory": 7, "product_catalog": 6, "opportunity": 5, "account": 4}


def test_expectations_measure_and_keep_rows(rows):
    out = {r.expectation: (r.passed, r.failed) for r in quality.measure(rows, {"pos": "n > 0", "id": "id IS NOT NULL"}).collect()}
    assert out == {"pos": (2, 3), "id": (4, 1)}


def test_reconciliation_gate(spark, rows, rules):
    valid, bad = quality.split(rows, rules)
    empty = rows.limit(0)
    report = gates.reconcile({"d": (rows, valid, bad), "none": (empty, empty, empty)})
    assert {(r.dataset, r.total, r.valid, r.quarantined) for r in report.collect()} == {("d", 5, 2, 3), ("none", 0, 0, 0)}
    gates.require_reconciled(report)
    with pytest.raises(gates.GateFailed):
        gates.require_reconciled(gates.reconcile({"d": (rows, valid, bad.limit(1))}))


def test_gold_checks(spark):
    fact = spark.createDataFrame(
        [("t1", 1, "c1", "p1"), ("t1", 1, "c9", "p1"), (None, 2, None, "p9"), ("t4", None, "c9", "p9")],
        "transaction_id string, date_key int, customer_id string, product_id string",
    )
    customers = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    dates = spark.createDataFrame([(1,), (None,)], "date_key int")
    report = gates.gold_checks(gates.Star(fact, customers, products, dates))
    found = {r.check_name: r.violations for r in report.collect()}
    assert len(found) == 11
    assert {k: v for k, v in found.items() if v} == {
        "fact_sales.transaction_id_not_null": 1,
        "fact_sales.transaction_id_unique": 2,
        "dim_customer.customer_id_unique": 1,
        "dim_date.date_key_not_null": 1,
        "dim_date.date_key_unique": 1,
        "fact_sales.customer_fk": 2,
        "fact_sales.product_fk": 2,
        "fact_sales.date_fk": 1,
    }
    with pytest.raises(gates.GateFailed):
        gates.require_gold(report)
    gates.require_gold(report, allowed=2)
