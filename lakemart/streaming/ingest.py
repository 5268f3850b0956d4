"""Incremental ingest of CSV drops whose header may change.

The stream follows the *list* of files (path only; no content is read for it),
so each file is taken once.  Every micro-batch reads its files by header, adds
new columns, and replaces its own folder of the table.  A record that names the
folder's files then makes the batch valid.  Readers and following streams go by the
records alone: a batch that died half-way is not seen, and running it again adds
nothing twice.
"""

from __future__ import annotations

import csv
import json
import re
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.contracts import BRONZE_TRANSACTIONS
from lakemart.sources import files
from lakemart.sources.tables import COMPRESSION
from lakemart.streaming.committed import follow

FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"
RESCUED = "_rescued_data"
BATCH = "ingest_batch"


@dataclass(frozen=True)
class CsvDrops:
    """A folder of CSV files and the table they are appended to."""

    source: str
    table: str
    state: str  # checkpoint and schema live here
    hints: str = BRONZE_TRANSACTIONS
    null_token: str = "null"
    glob: str = "{*.csv,*.csv.gz}"
    max_files: int = 1000  # files per micro-batch

    @property
    def schema_path(self) -> str:
        return f"{self.state}/schema"

    @property
    def commits(self) -> str:
        return f"{self.state}/commits"


def run(spark: SparkSession, drops: CsvDrops) -> None:
    """Take every file not taken before, then stop."""
    listing = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", drops.glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", drops.max_files)
        .load(drops.source)
        .select("path")
    )
    query = (
        listing.writeStream.option("checkpointLocation", f"{drops.state}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda paths, batch: _take(paths.sparkSession, drops, paths, batch))
        .start()
    )
    query.awaitTermination()


def _take(spark: SparkSession, drops: CsvDrops, paths: DataFrame, batch: int) -> None:
    folder = f"{BATCH}={batch}"
    record = f"{drops.commits}/{batch:012d}"
    if files.exists(spark, record):
        return
    taken = sorted(row.path for row in paths.collect())  # at most max_files names
    known = table_schema(spark, drops)
    rows = read_drops(spark, taken, drops.hints, drops.null_token)
    if rows is None:
        return
    grown = _merged(known, rows.schema)
    if grown != known:
        _save_schema(spark, drops, grown, batch)
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{drops.table}/{folder}")
    written = [f"{folder}/{n}" for n in files.names(spark, f"{drops.table}/{folder}") if not n.startswith(("_", "."))]
    files.write_once(spark, record, json.dumps({"batch": batch, "files": written}))


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names by file, from one scan; files without any line are left out.

    A file's first line stands in the piece that starts at its first byte; other
    pieces are not looked at.  A compressed file is one piece: beside an (empty) set
    the minimum is kept by hashing, alone it would sort all lines first.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    said = lines.where((F.col("file_block_start") == 0) & (F.trim("value") != "")).withColumn("line", F.monotonically_increasing_id())
    kept = F.min_by("value", "line").alias("value"), F.collect_set(F.lit(None).cast("int")).alias("_none")
    first = said.groupBy("file_path").agg(*kept).collect()  # one line per file
    found = {_plain_path(unquote(r.file_path)): _column_names(r.value) for r in first}
    return {p: found[_plain_path(p)] for p in paths if _plain_path(p) in found}


def _plain_path(path: str) -> str:
    """One spelling of a path: with its scheme, and one slash behind it."""
    return re.sub(r"^(\w+):/+", r"\1:/", path if ":" in path.split("/")[0] else f"file:{path}")


def _column_names(line: str) -> tuple[str, ...]:
    """The names Spark's CSV reader would give: numbered where empty or used twice."""
    names = next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"))
    often = Counter(n.lower() for n in names)
    return tuple(f"_c{i}" if not n else f"{n}{i}" if often[n.lower()] > 1 else n for i, n in enumerate(names))


def read_drops(spark: SparkSession, files: list[str], hints: str, null_token: str = "null") -> DataFrame | None:
    """Files with any mix of headers as one table, columns matched by name."""
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, columns in headers(spark, files).items() if files else ():
        by_header[columns].append(path)

    hinted = {f.name: f for f in StructType.fromDDL(hints)}
    out = None
    for columns, paths in by_header.items():
        text = StructType([StructField(c, StringType()) for c in columns])
        raw = spark.read.csv(paths, schema=text, header=True, nullValue=null_token)
        part = raw.select(
            *(_typed(c, hinted).alias(c) for c in columns),
            _rescued([c for c in columns if c in hinted], hinted).alias(RESCUED),
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _typed(column: str, hinted: dict[str, StructField]) -> Column:
    kind = hinted[column].dataType if column in hinted else StringType()
    return F.col(column) if isinstance(kind, StringType) else F.col(column).try_cast(kind)


def _rescued(columns: list[str], hinted: dict[str, StructField]) -> Column:
    """JSON of the values that do not fit their hinted type; NULL if all fit."""
    doubtful = [c for c in columns if not isinstance(hinted[c].dataType, StringType)]
    if not doubtful:
        return F.lit(None).cast("string")
    lost = [F.when(_typed(c, hinted).isNull(), F.col(c)).alias(c) for c in doubtful]
    return F.when(F.coalesce(*lost).isNotNull(), F.to_json(F.struct(*lost)))


def _merged(known: StructType | None, new: StructType) -> StructType:
    fields = list(known.fields) if known else []
    names = {f.name for f in fields}
    return StructType(fields + [f for f in new.fields if f.name not in names])


def _save_schema(spark: SparkSession, drops: CsvDrops, schema: StructType, batch: int) -> None:
    """One folder per batch: nothing saved before is ever replaced."""
    line = spark.createDataFrame([(schema.json(),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{drops.schema_path}/{BATCH}={batch}")


def table_schema(spark: SparkSession, drops: CsvDrops) -> StructType | None:
    """The table's schema as grown so far; None before the first batch."""
    try:
        lines = spark.read.text(drops.schema_path).collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = []
    if not lines:
        if files.names(spark, drops.commits):
            raise ValueError(f"{drops.table} has batches, but its schema is gone from {drops.schema_path}")
        return None
    schema = None
    for line in sorted(lines, key=lambda x: x[BATCH]):
        schema = _merged(schema, StructType.fromJson(json.loads(line.value)))
    return schema


def _read_schema(spark: SparkSession, drops: CsvDrops) -> StructType:
    schema = table_schema(spark, drops)
    if schema is None:
        raise ValueError(f"nothing was ingested into {drops.table} yet")
    return schema


def committed(spark: SparkSession, drops: CsvDrops) -> list[dict]:
    """The records so far, in order: batch and files."""
    return [json.loads(files.read_text(spark, f"{drops.commits}/{n}")) for n in files.names(spark, drops.commits) if n.isdigit()]


def _read(spark: SparkSession, drops: CsvDrops, records: list[dict]) -> DataFrame:
    schema = _read_schema(spark, drops)
    named = [f"{drops.table}/{f}" for r in records for f in r["files"]]
    return spark.read.schema(schema).parquet(*named) if named else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, drops: CsvDrops) -> DataFrame:
    """The table so far.  The saved schema spares a look into every file."""
    return _read(spark, drops, committed(spark, drops))


def follow_table(spark: SparkSession, drops: CsvDrops, checkpoint: str, take: Callable[[DataFrame, int], None], at_once: int = 100) -> None:
    """Hand the rows of newly committed batches to ``take(rows, number)``, then stop."""
    if files.names(spark, drops.commits):
        follow(spark, drops.commits, checkpoint, lambda records, number: take(_read(spark, drops, records), number), at_once)
