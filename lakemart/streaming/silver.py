"""Bronze streams to Silver tables, with expectations counted on the way."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import quality
from lakemart.streaming import ingest
from lakemart.streaming.committed import CommittedParts, FirstArrivals

BATCH = "silver_batch"


@dataclass(frozen=True)
class SilverStream:
    """One dataset's stream: builder, target and state folders."""

    dataset: str
    build: Callable[[DataFrame], DataFrame]
    table: str
    state: str
    key: str | None = None  # deduplicate on it, first arrival wins
    event_time: str | None = None  # bounds the deduplication state, with:
    within: str = "7 days"


def rows(stream: DataFrame, spec: SilverStream) -> DataFrame:
    """The streaming plan: the batch builder, then stateful deduplication.

    Without ``event_time`` every key is remembered for ever; with it, only
    repeats within the given time are dropped and older state is released.
    """
    built = spec.build(stream)
    if spec.key is None:
        return built
    if spec.event_time is None:
        return built.dropDuplicates([spec.key])
    return built.withWatermark(spec.event_time, spec.within).dropDuplicatesWithinWatermark([spec.key])


def run(stream: DataFrame, spec: SilverStream) -> None:
    """Process everything available and stop; safe to run again."""
    expectations = quality.load_expectations(spec.dataset)

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation(f"{spec.dataset}_{number}")
        counted = quality.observe(batch, expectations, seen)
        counted.write.mode("overwrite").parquet(f"{spec.table}/{BATCH}={number}")
        total = seen.get["rows"]
        lines = [(spec.dataset, name, seen.get[name], total - seen.get[name]) for name in expectations]
        metrics = batch.sparkSession.createDataFrame(
            lines, "dataset string, expectation string, passed bigint, failed bigint"
        )
        metrics.coalesce(1).write.mode("overwrite").parquet(f"{spec.state}/metrics/{BATCH}={number}")

    query = (
        rows(stream, spec)
        .writeStream.option("checkpointLocation", f"{spec.state}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def run_committed(spark: SparkSession, drops: ingest.CsvDrops, spec: SilverStream, order: tuple[str, ...]) -> None:
    """Bring Silver up to the committed batches of Bronze; safe to run again.

    Rows whose key came before are dropped; within a batch the first in ``order``
    counts.  Expectations are measured on the rows that are new.
    """
    expectations = quality.load_expectations(spec.dataset)
    target = first_arrivals(spec, order)

    def take(bronze: DataFrame, number: int) -> None:
        def measure(new: DataFrame) -> None:
            lines = quality.measure(new, expectations).withColumn("dataset", F.lit(spec.dataset))
            lines = lines.select("dataset", "expectation", "passed", "failed")
            lines.coalesce(1).write.mode("overwrite").parquet(f"{spec.state}/metrics/{BATCH}={number}")

        target.apply(spec.build(bronze), number, measure)

    ingest.follow_table(spark, drops, f"{spec.state}/checkpoint", take)


def first_arrivals(spec: SilverStream, order: tuple[str, ...] = ()) -> FirstArrivals:
    return FirstArrivals(CommittedParts(spec.table, (spec.key,)), order)


def read_table(spark: SparkSession, spec: SilverStream) -> DataFrame:
    return spark.read.parquet(spec.table).drop(BATCH)


def read_metrics(spark: SparkSession, spec: SilverStream) -> DataFrame:
    """Passed and failed rows per expectation over all batches."""
    batches = spark.read.parquet(f"{spec.state}/metrics")
    return batches.groupBy("dataset", "expectation").agg({"passed": "sum", "failed": "sum"}).withColumnsRenamed(
        {"sum(passed)": "passed", "sum(failed)": "failed"}
    )
