"""References to records that don't exist, from signed counts per key.

Change deltas are rows ``key, at, refs, exist``: +1 or -1 whenever a reference or a record appears or goes, with the
moment at which it does. Their sums per key and moment are the whole state. Summed over a key's moments they say what
holds now: a key with positive references and no existence is an orphan. Summed up to a moment they say what held
then. Because sums commute, deltas may arrive in any order, and states kept apart can be put together later.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dusklark.functions.text import identifier
from dusklark.operators.skew import lookup_join
from dusklark.session import SharedFiles

#: Folders of a stored state before they are put together.
MAX_CHANGES = 8


def _zero() -> Column:
    return F.lit(0).cast("long")


def deltas(rows: DataFrame, refs: Column | None = None, exist: Column | None = None) -> DataFrame:
    """Change deltas ``key, at, refs, exist`` from rows with ``key`` and ``at``; a count not given is 0."""
    return rows.select("key", "at", (_zero() if refs is None else refs.cast("long")).alias("refs"), (_zero() if exist is None else exist.cast("long")).alias("exist"))


def apply_deltas(state: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The state ``key, at, refs, exist`` after the deltas; moments whose counts are both zero leave it.

    Rows with a NULL key are no information and are left out, NULL counts are read as 0, a NULL moment is the one
    before all others. Sums are partly done before the shuffle, so a key with a third of all deltas costs at most as
    many rows per input partition as it has moments there.
    """
    columns = ["key", "at", "refs", "exist"]
    rows = changes.select(*columns) if state is None else state.select(*columns).unionByName(changes.select(*columns))
    summed = rows.filter(F.col("key").isNotNull()).groupBy("key", "at").agg(F.sum(F.coalesce("refs", _zero())).alias("refs"), F.sum(F.coalesce("exist", _zero())).alias("exist"))
    return summed.filter("refs <> 0 OR exist <> 0")


class CountStore:
    """A state kept as a table: batches of deltas are summed and added as a folder, and put together from time to time.

    Batches carry growing numbers; one that is not above the last applied was taken in before and changes nothing, so a
    batch may be tried again after a failure. Folders become visible with an exclusively created manifest.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), SharedFiles(spark, path)

    def _manifest(self) -> dict:
        names = [n for n in self.files.names(f"{self.path}/manifest") if n.endswith(".json")]
        return json.loads(self.files.read(f"{self.path}/manifest/{names[-1]}")) if names else {"version": 0, "batch": None, "folders": []}

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Add one batch of deltas; false if it was applied before."""
        now = self._manifest()
        if now["batch"] is not None and batch <= now["batch"]:
            return False
        attempt = f"{now['version'] + 1:08d}-{uuid.uuid4().hex}"
        whole = len(now["folders"]) >= MAX_CHANGES
        apply_deltas(self._read(now["folders"]) if whole else None, changes).write.parquet(f"{self.path}/{attempt}")
        published = {"version": now["version"] + 1, "batch": batch, "folders": [attempt] if whole else [*now["folders"], attempt]}
        if not self.files.write_new(f"{self.path}/manifest/{published['version']:08d}.json", json.dumps(published)):
            self.files.delete(f"{self.path}/{attempt}")
            raise RuntimeError(f"version {published['version']} was published by another writer; apply the batch again")
        return True

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders])

    def state(self) -> DataFrame:
        """The counts of all batches so far: ``key, at, refs, exist``."""
        folders = self._manifest()["folders"]
        if not folders:
            raise ValueError("no deltas were applied yet")
        # one folder is summed already
        return self._read(folders) if len(folders) == 1 else apply_deltas(None, self._read(folders))


def orphan_keys(state: DataFrame) -> DataFrame:
    """The current report: keys with positive references and no existence, ``key, refs``."""
    now = state.groupBy("key").agg(F.sum("refs").alias("refs"), F.sum("exist").alias("exist"))
    return now.filter("refs > 0 AND exist <= 0").select("key", "refs")


def orphan_moments(state: DataFrame) -> DataFrame:
    """Moments at which a key has references and, by the counts up to then, no existence: ``key, at, refs, kind``.

    kind: ``missing`` if the key's existence was never raised, else ``deleted`` if it was lowered at or before the
    moment, else ``late``. A key's existence changes are one row; reference counts reach it by a join in which hot
    keys are broadcast, so a third of all references may name one key.
    """
    changes = state.filter("exist <> 0").groupBy("key").agg(F.collect_list(F.struct("at", "exist")).alias("_changes"))
    x = lookup_join(state.filter("refs > 0").select("key", "at", "refs"), changes, ["key"])

    def total(counts: Column) -> Column:
        return F.aggregate(counts, _zero(), lambda a, b: a + b)

    known = F.coalesce(F.col("_changes"), F.array())
    until = F.filter(known, lambda v: v["at"].isNull() | F.coalesce(v["at"] <= F.col("at"), F.lit(False)))
    x = x.withColumn("_then", total(F.transform(until, lambda v: v["exist"])))
    raised = total(F.transform(known, lambda v: F.greatest(v["exist"], _zero())))
    lowered = total(F.transform(until, lambda v: F.least(v["exist"], _zero())))
    kind = F.when(raised == 0, "missing").when(lowered < 0, "deleted").otherwise("late")
    return x.filter("_then <= 0").select("key", "at", "refs", kind.alias("kind"))


def record_deltas(records: DataFrame, key: str, born: str, voids: DataFrame, void_key: str, gone: str) -> DataFrame:
    """Existence deltas: +1 when a record is first received, -1 when it is first withdrawn.

    Repeated deliveries and repeated withdrawals of one key count once, at their earliest moment.
    """
    first = lambda df, name, at: df.select(identifier(F.col(name)).alias("key"), F.col(at).alias("at")).filter("key IS NOT NULL").groupBy("key").agg(F.min("at").alias("at"))
    return deltas(first(records, key, born), exist=F.lit(1)).unionByName(deltas(first(voids, void_key, gone), exist=F.lit(-1)))


def references(table_name: str, rows: DataFrame, child: Column, parent: Column, at: Column, row: Column) -> DataFrame:
    """References ``child_table, child_id, row_id, key, at``: one per child and key named, at the child's earliest moment.

    A NULL or blank key is no reference. A child without an identifier is told apart by ``row`` (kept as ``row_id``,
    NULL for all others) and has NULL as ``child_id``.
    """
    plain = rows.select(child.alias("child_id"), F.when(child.isNull(), row.cast("string")).alias("row_id"), identifier(parent).alias("key"), at.alias("_at"))
    who = ["child_id", "row_id"]
    pairs = plain.groupBy(*who, "key").agg(F.min("_at").alias("_at"))
    named = pairs.filter("child_id IS NOT NULL")
    moments = named.groupBy("child_id").agg(F.min("_at").alias("at"))
    found = named.filter("key IS NOT NULL").select(*who, "key").join(moments, "child_id")
    nameless = pairs.filter("child_id IS NULL AND key IS NOT NULL").select(*who, "key", F.col("_at").alias("at"))
    return found.unionByName(nameless).select(F.lit(table_name).alias("child_table"), *who, "key", "at")


def orphan_references(refs: DataFrame, state: DataFrame) -> DataFrame:
    """References that the counts show to be orphans at their moment: ``child_table, child_id, row_id, key, moment, kind``.

    state: the counts with these references among them.
    """
    moments = orphan_moments(state).withColumn("_at", F.unix_micros("at")).drop("at", "refs")
    # a NULL moment meets a NULL moment
    found = lookup_join(refs.withColumn("_at", F.unix_micros("at")).fillna({"_at": -(2**63)}), moments.fillna({"_at": -(2**63)}), ["key", "_at"])
    return found.filter("kind IS NOT NULL").select("child_table", "child_id", "row_id", "key", F.col("at").alias("moment"), "kind")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month of their moment and kind: ``child_table, period, kind, orphans, keys``."""
    period = F.date_format("moment", "yyyy-MM")
    return orphans.groupBy("child_table", period.alias("period"), "kind").agg(F.count(F.lit(1)).alias("orphans"), F.count_distinct("key").alias("keys"))
