"""Tables that a stream changes batch by batch, valid files named by commit records.

A table lies in ``parts`` folders by key hash.  A batch writes only the parts it
touches, into folders of its own, and then one small record that names the valid
folders of every part.  Readers follow the last record: a batch that died before
its record has changed nothing, and running it again replaces what it left.  A batch
whose number is recorded already is skipped.

One record can carry several tables (rows and the log they come from), which so move
together.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators import cdc
from lakemart.sources import files
from lakemart.sources.tables import COMPRESSION, estimated_bytes, materialize, pieces

APPEND, REPLACE = "append", "replace"
PART = "_part"
FEW_BYTES = 4 << 20  # of written keys that every task may hold


@dataclass(frozen=True)
class CommittedParts:
    """Tables keyed alike, below one root folder."""

    root: str
    keys: tuple[str, ...]
    parts: int = 32

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int").alias(PART)

    # ------------------------------------------------------------- records
    def _record_path(self, batch: int) -> str:
        return f"{self.root}/commits/{batch:012d}"

    def last(self, spark: SparkSession) -> dict:
        """The last record: batch, valid folders by table and part, schemas, parts written."""
        done = [n for n in files.names(spark, f"{self.root}/commits") if n.isdigit()]
        if not done:
            return {"batch": -1, "tables": {}, "schemas": {}, "written": {}}
        return json.loads(files.read_text(spark, f"{self.root}/commits/{done[-1]}"))

    def committed(self, spark: SparkSession, batch: int) -> bool:
        return self.last(spark)["batch"] >= batch

    # --------------------------------------------------------------- tables
    def read(self, spark: SparkSession, table: str, parts: Sequence[int] | None = None, schema: StructType | None = None) -> DataFrame:
        """The table, or some of its parts, as of the last record.

        ``schema`` stands in as long as the table has no record.
        """
        record = self.last(spark)
        found = record["schemas"].get(table)
        schema = StructType.fromJson(found) if found else schema
        if schema is None:
            raise ValueError(f"{self.root} has no table {table} yet")
        wanted = record["tables"].get(table, {})
        chosen = wanted if parts is None else {str(p): wanted[str(p)] for p in parts if str(p) in wanted}
        folders = [f"{self.root}/{f}" for part in chosen.values() for f in part]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def write(self, rows: DataFrame, table: str, batch: int) -> None:
        """Put a batch's rows of one table into its own folders; not valid before :meth:`commit`.

        Rows with a column ``_part`` lie together by part already.
        """
        if PART not in rows.columns:
            # The rows of one part stay together unless they are many: adaptive execution cuts large pieces.
            rows = rows.withColumn(PART, self.part()).hint("rebalance", F.col(PART))
        rows.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(PART).parquet(f"{self.root}/{table}/batch={batch}")

    def written(self, spark: SparkSession, table: str, batch: int, schema: StructType) -> DataFrame:
        """What :meth:`write` has written, before it is valid."""
        return spark.read.schema(schema).parquet(f"{self.root}/{table}/batch={batch}").drop(PART)

    def commit(self, spark: SparkSession, batch: int, tables: dict[str, tuple[str, Sequence[int], StructType]]) -> None:
        """Make written folders valid: (append or replace, touched parts, schema) by table."""
        record = self.last(spark)
        if record["batch"] >= batch:
            return
        record["batch"], record["written"] = batch, {}
        for table, (mode, touched, schema) in tables.items():
            valid = record["tables"].setdefault(table, {})
            names = files.names(spark, f"{self.root}/{table}/batch={batch}")
            new = {n.removeprefix(f"{PART}="): f"{table}/batch={batch}/{n}" for n in names if n.startswith(f"{PART}=")}
            for part in map(str, touched):
                kept = valid.pop(part, []) if mode == APPEND else []
                valid.pop(part, None)
                folders = kept + ([new[part]] if part in new else [])
                if folders:
                    valid[part] = folders
            record["schemas"][table] = json.loads(schema.json())
            record["written"][table] = sorted(map(int, new))
        files.write_once(spark, self._record_path(batch), json.dumps(record, sort_keys=True))

    def touched(self, rows: DataFrame) -> list[int]:
        """Parts that hold keys of these rows: at most ``parts`` numbers."""
        return sorted(r[0] for r in rows.select(self.part()).distinct().collect())

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Delete folders that the last record does not name; for times without readers of older records."""
        record, gone = self.last(spark), []
        named = {f for table in record["tables"].values() for part in table.values() for f in part}
        for table in record["tables"]:
            for batch in files.names(spark, f"{self.root}/{table}"):
                if int(batch.removeprefix("batch=")) > record["batch"]:
                    continue  # a batch on its way
                for part in files.names(spark, f"{self.root}/{table}/{batch}"):
                    path = f"{table}/{batch}/{part}"
                    if part.startswith(f"{PART}=") and path not in named:
                        files.delete(spark, f"{self.root}/{path}")
                        gone.append(path)
        return gone


# ---------------------------------------------------------- current state (SCD1)


@dataclass(frozen=True)
class CurrentState:
    """The latest version of each key, kept up to date by a stream of changes.

    Deleted keys stay as tombstones, so that an older change that comes late
    cannot bring them back.  Any order and any cut of a feed into batches gives
    the rows of :func:`cdc.current_state` over the whole feed.
    """

    store: CommittedParts
    seq: str = "seq"
    op: str = "op"

    def apply(self, batch: DataFrame, number: int) -> None:
        """``foreachBatch`` function."""
        spark, store = batch.sparkSession, self.store
        if store.committed(spark, number):
            return
        touched = store.touched(batch)
        both = store.read(spark, "versions", touched, batch.schema).unionByName(batch)
        rest = [c for c in batch.columns if c not in (*store.keys, self.seq)]
        order = [F.col(self.seq).desc(), *(F.col(c).desc_nulls_last() for c in rest)]
        store.write(cdc.first_per_key(both, store.keys, order), "versions", number)
        store.commit(spark, number, {"versions": (REPLACE, touched, batch.schema)})

    def read(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, "versions").filter(F.col(self.op) != "D").drop(self.seq, self.op)


# -------------------------------------------------------------- history (SCD2)


@dataclass(frozen=True)
class History:
    """Validity intervals, kept up to date by a stream of changes in any order.

    All changes are kept in a log by key hash.  A batch works the intervals of
    the keys it brings out anew from their part of the log, so a late change
    splits an interval that was closed long ago.  Other keys of a touched part
    are copied.  Any order and any cut of a feed into batches gives the rows of
    :func:`cdc.history` over the whole feed.
    """

    store: CommittedParts
    seq: str = "seq"
    op: str = "op"
    track: tuple[str, ...] | None = None

    def apply(self, batch: DataFrame, number: int) -> None:
        """``foreachBatch`` function."""
        spark, store = batch.sparkSession, self.store
        if store.committed(spark, number):
            return
        store.write(batch, "log", number)
        changes = store.written(spark, "log", number, batch.schema)
        touched = store.touched(changes)
        changed = changes.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(store.keys))).distinct()
        same = F.lit(True)
        for i, k in enumerate(store.keys):
            same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
        log = store.read(spark, "log", touched, batch.schema).join(changed, same, "left_semi").unionByName(changes)
        fresh = cdc.history(log, list(store.keys), self.seq, self.op, self.track)
        kept = store.read(spark, "history", touched, fresh.schema).join(changed, same, "left_anti")
        store.write(kept.unionByName(fresh), "history", number)
        store.commit(spark, number, {"log": (APPEND, touched, batch.schema), "history": (REPLACE, touched, fresh.schema)})

    def read(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, "history")


# ------------------------------------------------------- first arrivals (dedup)


@dataclass(frozen=True)
class FirstArrivals:
    """Rows whose key has not come before; repeats are dropped, rows are only appended.

    Within a batch the first row in ``order`` counts.  All rows without a key count
    as one.

    The batch is shuffled once: by part and a share of it, together with the bare keys
    that came before, of which there is one each and which stand first.  Once rows have
    come before, keys are compared first: where few are new, only their rows are shuffled.
    """

    store: CommittedParts
    order: tuple[str, ...]

    def apply(self, batch: DataFrame, number: int, before_commit: Callable[[DataFrame], None] | None = None) -> None:
        """``foreachBatch`` function; ``before_commit`` gets the new rows, written but not valid yet."""
        spark, store = batch.sparkSession, self.store
        if store.committed(spark, number):
            return
        order = [F.col(c).asc_nulls_first() for c in self.order]
        dealt, known = pieces(batch, 4 << 20), None
        if store.last(spark)["tables"].get("rows"):
            known = store.read(spark, "rows", store.touched(batch)).select(*store.keys)
            names = [f"_k{i}" for i in range(len(store.keys))]
            same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(store.keys, names)))
            new = materialize(batch.select(*store.keys).distinct().join(known.toDF(*names), same, "left_anti").toDF(*names), "new-keys")
            if estimated_bytes(new) <= FEW_BYTES:
                batch, known = batch.join(F.broadcast(new), same, "left_semi"), None
        rows = cdc.few_without_key(batch, store.keys, order).withColumn("_known", F.lit(False))
        if known is not None:
            rows = rows.unionByName(known.withColumn("_known", F.lit(True)), allowMissingColumns=True)
        share = F.pmod(F.xxhash64(F.lit("share"), *store.keys), F.lit(-(-(dealt or 1) // store.parts)))
        rows = rows.withColumns({PART: store.part(), "_share": share}).repartition(*([dealt] if dealt else []), PART, "_share")
        first = cdc.first_per_key(rows, [PART, "_share", *store.keys], [F.col("_known").desc(), *order])
        store.write(first.filter(~F.col("_known")).drop("_known", "_share"), "rows", number)
        if before_commit:
            before_commit(store.written(spark, "rows", number, batch.schema))
        store.commit(spark, number, {"rows": (APPEND, range(store.parts), batch.schema)})

    def read(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, "rows")


def run_changes(stream: DataFrame, target: CurrentState | History, checkpoint: str) -> None:
    """Apply everything available of a change stream, then stop; safe to run again."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(target.apply).start()
    query.awaitTermination()


# -------------------------------------------------- committed batches as a stream


def follow(spark: SparkSession, commits: str, checkpoint: str, take: Callable[[list[dict], int], None], at_once: int = 100) -> None:
    """Hand every new record of a folder of commit records to ``take(records, batch)``, then stop."""

    def handle(lines: DataFrame, number: int) -> None:
        records = [json.loads(r.value) for r in lines.collect()]  # at most ``at_once`` records
        if records:
            take(sorted(records, key=lambda r: r["batch"]), number)

    query = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", at_once).option("wholetext", "true").text(commits)
        .writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
    )
    query.awaitTermination()
