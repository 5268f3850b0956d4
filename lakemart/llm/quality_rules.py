"""Host-level quality rules with rates shrunk by an empirical beta prior.

Every whole text gets its figures and base rules.  The failures are counted per
host; a beta prior fitted to all hosts' rates by moments pulls the rates of
small hosts towards the corpus; a host is rejected if the lower bound of its
shrunk rate lies above ``host_limit``.  The verdict goes back to the documents
by a join.

NULL or empty text: all figures 0, base_failed.  NULL host: a host of its own.
Repeated rows each count.  Empty table: no rows.  Figures that the input
already has under the same names are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakemart.llm.common import SPACES, batch_of, set_aside, ship, slices, stored

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
SPACE_BYTES = SPACES.encode()
RULES = ("few_words", "repeats", "symbols", "dup_lines")


def repeated_positions(codes: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    windows = len(codes) - width + 1
    if windows < 2:
        return 0
    packed = codes[:windows]
    for shift in range(1, width):
        base = int(codes.max()) + 1
        if int(packed.max()) + 1 > (1 << 62) // base:
            packed = np.unique(packed, return_inverse=True)[1]
        packed = packed * base + codes[shift : shift + windows]
    order = np.argsort(packed, kind="stable")
    same = packed[order][1:] == packed[order][:-1]
    twice = np.zeros(windows, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(width):
        covered[shift : shift + windows] |= twice
    return int(covered.sum())


def figures(text: str) -> tuple[int, int, int, int, int]:
    """FIGURES of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six characters of SPACES
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    spaces = len(raw) - len(raw.translate(None, SPACE_BYTES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_positions(codes)


def measure(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns with FIGURES of every whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__text"):
            rows = np.array([figures(t) for t in texts], dtype=np.int64).reshape(-1, len(FIGURES))
            yield batch_of(batch, keys, **{n: rows[:, i] for i, n in enumerate(FIGURES)})

    picked = docs.select(*keys, docs[text].alias("__text"))
    schema = StructType([*(picked.schema[k] for k in keys), *(StructField(n, LongType()) for n in FIGURES)])
    return picked.mapInArrow(run, schema)


def with_rules(figured: DataFrame) -> DataFrame:
    """Base rule and the rules whose failures are counted per host."""
    few = F.col("n_words") < 50
    repeats = F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words")
    return figured.withColumns(
        {
            "few_words": few,
            "repeats": repeats,
            "symbols": F.lit(10) * F.col("n_symbols") > F.col("word_chars"),
            "dup_lines": F.col("n_dup_lines") * 5 > F.col("n_words"),
            "base_failed": few | repeats,
        }
    )


def host_rates(ruled: DataFrame, host: str) -> DataFrame:
    """Per host: documents, failures of each rule, failures of any rule."""
    any_rule = F.lit(False)
    for rule in RULES:
        any_rule = any_rule | F.col(rule)
    return ruled.groupBy(host).agg(
        F.count(F.lit(1)).alias("host_docs"),
        *(F.count_if(rule).alias(f"{rule}_failures") for rule in RULES),
        F.count_if(any_rule).alias("failures"),
    )


def beta_prior(hosts: DataFrame) -> DataFrame:
    """One row: the beta prior (a, b) whose mean and spread fit the hosts' rates.

    The mean is the corpus rate; the strength a + b comes from the spread between
    hosts beyond binomial noise (by moments), held between 1 and 1,000,000.
    """
    rate = F.col("failures") / F.col("host_docs")
    totals = hosts.agg(
        F.sum("failures").alias("f"),
        F.sum("host_docs").alias("n"),
        F.count(F.lit(1)).alias("h"),
        F.sum(F.col("host_docs") * rate * rate).alias("q"),
    )
    mean = F.greatest(F.least(F.col("f") / F.col("n"), F.lit(0.999999)), F.lit(0.000001))
    noise = mean * (1 - mean)
    # Sum of n (rate - mean)^2 has the expectation h noise + (n - h) between, nearly.
    between = (F.col("q") - F.col("n") * mean * mean - F.col("h") * noise) / F.greatest(F.col("n") - F.col("h"), F.lit(1))
    strength = F.when(between <= 0, F.lit(1e6)).otherwise(
        F.greatest(F.least(noise / F.greatest(between, F.lit(1e-12)) - 1, F.lit(1e6)), F.lit(1.0))
    )
    return totals.select((mean * strength).alias("prior_a"), ((1 - mean) * strength).alias("prior_b"))


def host_verdicts(hosts: DataFrame, host_limit: float = 0.8, deviations: float = 2.0) -> DataFrame:
    """Hosts with their shrunk rate, its lower bound and host_rejected."""
    prior = beta_prior(hosts).first()  # one row, NULLs if there is no host
    a = F.lit(prior.prior_a) + F.col("failures")
    b = F.lit(prior.prior_b) + F.col("host_docs") - F.col("failures")
    shrunk = a / (a + b)
    lower = shrunk - deviations * F.sqrt(shrunk * (1 - shrunk) / (a + b + 1))
    return hosts.withColumns({"host_rate": shrunk, "host_lower": lower}).withColumn(
        "host_rejected", F.coalesce(F.col("host_lower") > host_limit, F.lit(False))
    )


def keep(docs: DataFrame, host: str = "source", text: str = "text", host_limit: float = 0.8) -> DataFrame:
    """The documents that judge() keeps, all columns, without moving the texts.

    The verdicts per host come first; then each text is measured where it lies.
    """
    rates = stored(host_rates(with_rules(measure(docs, [host], text)), host), "quality-hosts")
    rejected = stored(host_verdicts(rates, host_limit).where("host_rejected").select(F.col(host).alias("__host")), "quality-rejected")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            yield batch.filter(pa.array([passes(figures(t)) for t in texts], pa.bool_()))

    passed, back = set_aside(docs.mapInArrow(run, docs.schema))
    return back(passed.join(rejected, F.col(host).eqNullSafe(F.col("__host")), "left_anti"))


def passes(found: tuple[int, ...]) -> bool:
    """The base rule on FIGURES."""
    return found[0] >= 50 and 100 * found[4] <= 50 * found[0]


def judge(
    docs: DataFrame,
    keys: tuple[str, ...] = ("doc_id",),
    host: str = "source",
    text: str = "text",
    host_limit: float = 0.8,
) -> DataFrame:
    """The keys with the figures, base_failed, host_rate and kept of every document."""
    names = list(dict.fromkeys([*keys, host]))
    # Read twice (per host and per document), so the texts are measured once.
    ruled = stored(with_rules(measure(docs, names, text)), "quality-figures")
    hosts = stored(host_verdicts(stored(host_rates(ruled, host), "quality-hosts"), host_limit), "quality-verdicts")
    verdicts = hosts.select(F.col(host).alias("__host"), "host_rate", "host_rejected")
    return (
        ruled.join(verdicts, F.col(host).eqNullSafe(F.col("__host")))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .select(*keys, *FIGURES, "base_failed", "kept", *RULES, "host_rate", "host_rejected")
    )
