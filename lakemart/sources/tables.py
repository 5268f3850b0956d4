"""Tables as Parquet folders, and their entry in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakemart.session import scratch_dir

# Fixed value: about a third smaller on disk than Spark's default, for little time.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class TableSpec:
    """Registration of a table: name, comment, properties."""

    name: str
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table, schema included, and return it read back.

    Write to another folder than the one being read; a run gets its own.
    """
    df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The size the planner expects; of a plain scan, that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


UNKNOWN_BYTES = 1 << 50  # the planner's guess for rows that come from no file is larger
MOST_PIECES = 32  # times the session's number, for a size overestimated behind a join


def pieces(df: DataFrame, each: int = 2 << 20) -> int | None:
    """Into how many tasks to deal a table of ``each`` bytes a task; None for one that one piece per core holds.

    Adaptive execution merges the session's pieces by their compressed size, and rows
    that compress well then fill a task's memory; pieces of a given number stay apart.
    """
    session = df.sparkSession
    size, usual = estimated_bytes(df), int(session.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-size // each), MOST_PIECES * usual)
    return wanted if size < UNKNOWN_BYTES and wanted > min(usual, session.sparkContext.defaultParallelism) else None


def spread(df: DataFrame, by: str, least_bytes: int = 4 << 20) -> DataFrame:
    """Deal a plain scan out to all cores if it arrives in too few pieces.

    ``by`` is a column with many values; dealing by its hash needs no sort.

    Work on a file with one row group would run in one task.  A scan with at
    least as many pieces as the cluster has cores, as any large table has, and
    a scan too small to matter are returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) < least_bytes or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, by)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """A written copy in the shared scratch folder.

    For a table several steps of one job read: it cuts the lineage and, unlike
    a cache, outlives a lost executor.
    """
    return write_table(df, scratch_dir(df.sparkSession, label))


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, spec: TableSpec, path: str, columns: Mapping[str, str] | None = None, where: str = "") -> None:
    """Point the catalog name at a written folder.

    The name is a view, replaced in one step: at no moment is it missing, and
    readers of the former folder finish undisturbed, since the data stay where
    they are.  ``columns`` maps columns to the SQL shown in their place, ``where``
    limits the rows.
    """
    shown = dict(columns or {})
    names = spark.read.parquet(path).columns
    unknown = sorted(set(shown) - set(names))
    if unknown:
        raise ValueError(f"{path} has no columns {unknown}")
    listed = ", ".join(f"{shown[c]} AS `{c}`" if c in shown else f"`{c}`" for c in names)
    query = f"SELECT {listed} FROM parquet.`{path}`" + (f" WHERE {where}" if where else "")
    properties = dict(spec.properties) | ({"comment": spec.comment} if spec.comment else {})
    settings = "(" + ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items()) + ")"
    if not spark.catalog.tableExists(spec.name):
        spark.sql(f"CREATE VIEW {spec.name} AS {query}")
    else:  # CREATE OR REPLACE would drop the name first
        spark.sql(f"ALTER VIEW {spec.name} AS {query}")
    if properties:
        spark.sql(f"ALTER VIEW {spec.name} SET TBLPROPERTIES {settings}")


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content) of the files below a folder whose name fits ``glob``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
