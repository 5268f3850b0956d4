"""Expectations (measure only) and quality rules (split valid / quarantine)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

import yaml
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.functions.columns import is_blank

RULES_DIR = Path(__file__).resolve().parent.parent / "rules"
DATASETS = ("transactions", "opportunity", "inventory", "product_catalog", "account")

# Check function -> arguments it needs.
FUNCTIONS = {
    "is_not_null": ("column",),
    "is_not_null_and_not_empty": ("column",),
    "sql_expression": ("expression",),
}
CRITICALITIES = ("error", "warn")


@dataclass(frozen=True)
class Rule:
    name: str
    function: str
    arguments: dict = field(default_factory=dict)
    criticality: str = "error"

    def failed(self, null_passes: bool = True) -> Column:
        """TRUE exactly where the row breaks the rule, never NULL."""
        if self.function == "is_not_null":
            return F.col(self.arguments["column"]).isNull()
        if self.function == "is_not_null_and_not_empty":
            value = F.col(self.arguments["column"])
            if self.arguments.get("trim_strings"):
                return F.coalesce(is_blank(value), F.lit(True))
            return F.coalesce(value.isNull() | (value.cast("string") == ""), F.lit(True))
        holds = F.expr(self.arguments["expression"])
        return ~F.coalesce(holds, F.lit(null_passes))


# --------------------------------------------------------------------- files


def parse_rules(entries: Iterable[dict]) -> list[Rule]:
    """Rules from parsed YAML.

    Two spellings are read: the long one (``check: {function, arguments}``) and
    the short one of the files in ``rules/`` (``not_null``, ``not_blank`` or
    ``holds`` with its operand).
    """
    rules = []
    for entry in entries or []:
        check = entry.get("check") or {}
        function, arguments = check.get("function"), dict(check.get("arguments") or {})
        if "not_null" in entry:
            function, arguments = "is_not_null", {"column": entry["not_null"]}
        elif "not_blank" in entry:
            function = "is_not_null_and_not_empty"
            arguments = {"column": entry["not_blank"], "trim_strings": True}
        elif "holds" in entry:
            function, arguments = "sql_expression", {"expression": entry["holds"]}
        rules.append(
            Rule(
                name=entry.get("name") or "",
                function=function or "",
                arguments=arguments,
                criticality=entry.get("criticality", "error"),
            )
        )
    return rules


def load_rules(dataset: str, folder: str | Path = RULES_DIR) -> list[Rule]:
    return parse_rules(yaml.safe_load((Path(folder) / f"{dataset}.yml").read_text()))


def load_expectations(dataset: str, path: str | Path = RULES_DIR / "expectations.yml") -> dict[str, str]:
    """Expectation name -> predicate."""
    return yaml.safe_load(Path(path).read_text())[dataset]


def validate_rules(spark: SparkSession, rules: Iterable[Rule], schema: StructType) -> list[str]:
    """Every defect of the rules against a table schema, as messages."""
    return _defects(spark.createDataFrame([], schema), list(rules))


def _defects(probe: DataFrame, rules: list[Rule]) -> list[str]:
    errors = []
    usable = []
    for rule in rules:
        label = rule.name or "(unnamed rule)"
        if not rule.name:
            errors.append(f"{label}: a name is required")
        if rule.criticality not in CRITICALITIES:
            errors.append(f"{label}: unknown criticality {rule.criticality!r}")
        if rule.function not in FUNCTIONS:
            errors.append(f"{label}: unknown function {rule.function!r}")
            continue
        missing = [a for a in FUNCTIONS[rule.function] if not rule.arguments.get(a)]
        if missing:
            errors.append(f"{label}: missing argument {', '.join(missing)}")
        else:
            usable.append(rule)
    if _problem(probe, usable):
        # Look at them one by one only to name the culprits.
        found = ((rule, _problem(probe, [rule])) for rule in usable)
        errors += [f"{rule.name}: {text}" for rule, text in found if text]
    return errors


def _problem(probe: DataFrame, rules: list[Rule]) -> str:
    """What the analyser says about the rules; nothing is executed."""
    try:
        probe.select(*(r.failed().alias(f"r{i}") for i, r in enumerate(rules)))
    except PySparkException as problem:
        return str(problem).strip().splitlines()[0]
    return ""


# --------------------------------------------------------------------- split

ERROR_TYPE = "array<struct<name:string,criticality:string,message:string>>"


def _parsing_rules(df: DataFrame) -> list[Rule]:
    if "parse_failures" not in df.columns:
        return []
    return [Rule("readable_values", "sql_expression", {"expression": "size(parse_failures) = 0"})]


def _checked(df: DataFrame, rules: Iterable[Rule]) -> list[Rule]:
    rules = [*rules, *_parsing_rules(df)]
    problems = _defects(df, rules)
    if problems:
        raise ValueError("invalid quality rules: " + "; ".join(problems))
    return rules


def _message(rule: Rule) -> str:
    if rule.function == "sql_expression":
        return f"not satisfied: {rule.arguments['expression']}"
    what = "NULL" if rule.function == "is_not_null" else "NULL or blank"
    return f"{rule.arguments['column']} is {what}"


def annotate(df: DataFrame, rules: Iterable[Rule], null_passes: bool = True) -> DataFrame:
    """Add ``_errors`` and ``_warnings``: one struct per broken rule."""
    rules = _checked(df, rules)

    def broken(level: str) -> Column:
        hits = [
            F.when(
                r.failed(null_passes),
                F.struct(
                    F.lit(r.name).alias("name"),
                    F.lit(r.criticality).alias("criticality"),
                    F.lit(_message(r)).alias("message"),
                ),
            )
            for r in rules
            if r.criticality == level
        ]
        return F.array_compact(F.array(*hits)) if hits else F.array()

    return df.withColumns(
        {
            "_errors": broken("error").cast(ERROR_TYPE),
            "_warnings": broken("warn").cast(ERROR_TYPE),
        }
    )


def is_valid(rules: Iterable[Rule], null_passes: bool = True) -> Column:
    """No error rule is broken; a plain predicate that can move to the scan."""
    return reduce(
        lambda a, b: a & b,
        (~r.failed(null_passes) for r in rules if r.criticality == "error"),
        F.lit(True),
    )


def valid_rows(df: DataFrame, rules: Iterable[Rule], null_passes: bool = True) -> DataFrame:
    rules = _checked(df, rules)
    return df.filter(is_valid(rules, null_passes)).drop("parse_failures")


def quarantined_rows(df: DataFrame, rules: Iterable[Rule], null_passes: bool = True) -> DataFrame:
    checked = _checked(df, rules)
    return annotate(df.filter(~is_valid(checked, null_passes)), rules, null_passes)


def split(df: DataFrame, rules: Iterable[Rule], null_passes: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine).  Each row is in exactly one of them."""
    rules = list(rules)
    return valid_rows(df, rules, null_passes), quarantined_rows(df, rules, null_passes)


def reasons(quarantine: DataFrame, key: str) -> DataFrame:
    """One row per quarantined row and broken rule."""
    return quarantine.select(F.col(key).alias("row_key"), F.explode("_errors").alias("e")).select(
        "row_key", F.col("e.name").alias("rule")
    )


# -------------------------------------------------------------- expectations


def measure(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Passed and failed rows per expectation, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.expr(p)).alias(f"_p{i}") for i, p in enumerate(expectations.values())),
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(name).alias("expectation"),
                F.col(f"_p{i}").alias("passed"),
                (F.col("_rows") - F.col(f"_p{i}")).alias("failed"),
            )
            for i, name in enumerate(expectations)
        )
    )
    return counts.select(F.inline(lines))


def observe(df: DataFrame, expectations: dict[str, str], observation: Observation | str) -> DataFrame:
    """Count the same numbers while the rows pass by, for writers and streams."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.expr(p)).alias(name) for name, p in expectations.items()),
    )
