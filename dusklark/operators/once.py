"""Messages delivered more than once: a store that holds exactly one copy of each.

Layout below the store's folder::

    data/<attempt>/once_period__=<day>/...   winners, filed under the day on which they were received
    index/<attempt>/once_slot__=<n>/...      identifier -> day under which its winner is filed, as changes
    manifest/<version>.json                  which folders make up each day and each slot

An attempt is a version number and a random mark, so no two writers, and no two tries of one writer, share a folder.
A batch is taken in by looking its identifiers up in the index, reading only the days named there, putting those days'
winners together with the incoming messages and recomputing one winner per identifier. Those days are written anew;
days that only gain messages get a further folder. The index gets the entries that changed; a slot is put together
again once it has ``MAX_CHANGES`` folders, and slots double as identifiers grow. A new manifest, created exclusively,
makes all of it visible at once. A writer that dies before leaves unreferenced folders and nothing else; a writer that
finds its version taken starts over from the one that was published.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dusklark.functions.text import identifier
from dusklark.session import SharedFiles, discard, written

#: Identifiers a slot of the index holds on average before slots double, and folders of one slot or day before they are put together.
SLOT_ENTRIES, MAX_CHANGES = 2_000_000, 8
#: Versions kept for readers that opened them; seconds an unreferenced folder may belong to a writer at work.
KEEP_VERSIONS, ORPHAN_AGE = 3, 7 * 24 * 3600
#: Times a writer starts over because another one was faster.
TRIES = 20
KEY, PERIOD, SLOT, SEQ = "once_key__", "once_period__", "once_slot__", "once_seq__"
_EMPTY = {"version": 0, "data": {}, "index": {}, "schema": None, "slots": 1, "entries": 0}


def _comparable(kind: T.DataType) -> bool:
    """Whether values of a type have an order; maps have none."""
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def single_winners(df: DataFrame, key: str, rank: list[Column]) -> DataFrame:
    """One row per ``key``: the smallest by ``rank`` (ascending, NULL last), the whole row kept.

    An aggregate, not a window, so that copies are reduced before the shuffle: a third of all rows under one key
    become one row per input partition. Rows equal in ``rank`` are decided by the remaining columns, but for maps,
    which have no order. An empty table gives an empty table; a NULL key is a key.
    """
    order = F.struct(*[x for i, c in enumerate(rank) for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])
    rest = F.struct(*[F.col(c) for c in df.columns])
    if _comparable(df.schema):
        return df.groupBy(key).agg(F.min(F.struct(order.alias("o"), rest.alias("r"))).alias("_w")).select("_w.r.*")
    ordered = F.struct(*[F.col(f.name) for f in df.schema if _comparable(f.dataType)])
    return df.groupBy(key).agg(F.min_by(rest, F.struct(order.alias("o"), ordered.alias("r"))).alias("_w")).select("_w.*")


def _attempt(folder: str) -> str:
    return folder.rsplit("/", 1)[0]


class OnceStore:
    """Exactly-once storage of a feed that is delivered at least once.

    id_col: the identifier, compared without regard to case and surrounding white space. Messages whose identifier is
    NULL or blank can't be copies of each other: each is kept, told apart by ``delivery_col``.
    rank: orders the copies of a message; the smallest is kept (NULL last, then the smallest ``delivery_col``).
    period_col: the timestamp by whose day winners are filed. NULL goes to a part of its own, days outside 1970 to 2099
    to another, so the number of parts is bounded whatever the feed holds.
    An empty batch publishes nothing new but its version. Extra columns travel along; only the names ``once_key__``,
    ``once_period__``, ``once_slot__`` and ``once_seq__`` are taken.
    """

    def __init__(self, spark: SparkSession, path: str, id_col: str, delivery_col: str, period_col: str, rank: list[Column]):
        self.spark, self.path, self.id_col, self.delivery_col, self.period_col = spark, path.rstrip("/"), id_col, delivery_col, period_col
        self.order, self.files = [*rank, F.col(delivery_col)], SharedFiles(spark, path)

    # -- reading ---------------------------------------------------------------------------------------------------
    def _versions(self) -> list[str]:
        return [n for n in self.files.names(f"{self.path}/manifest") if n.endswith(".json")]

    def manifest(self) -> dict:
        names = self._versions()
        return json.loads(self.files.read(f"{self.path}/manifest/{names[-1]}")) if names else dict(_EMPTY)

    def _read(self, kind: str, part: str, folders: dict[str, list[str]], only: set[str] | None, schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/{kind}/{a}/{part}={p}" for p, attempts in folders.items() if only is None or p in only for a in attempts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def current(self) -> DataFrame:
        """The kept messages, as they were delivered."""
        now = self.manifest()
        if now["schema"] is None:
            raise ValueError("nothing was taken in yet")
        return self._read("data", PERIOD, now["data"], None, self._schema(now)).drop(KEY)

    @staticmethod
    def _schema(manifest: dict) -> T.StructType:
        return T.StructType.fromJson(manifest["schema"])

    def _period(self) -> Column:
        day = F.date_format(F.col(self.period_col), "yyyy-MM-dd")
        return F.when(day.isNull(), "none").when(F.year(self.period_col).between(1970, 2099), day).otherwise("outside")

    # -- writing ---------------------------------------------------------------------------------------------------
    def ingest(self, batch: DataFrame) -> int:
        """Take in one batch and return the version that holds it; the same batch again changes no message."""
        # the mark keeps made-up keys apart from any identifier
        own = F.coalesce(identifier(F.col(self.id_col)), F.concat(F.lit("\u0000"), F.col(self.delivery_col).cast("string")))
        incoming = single_winners(batch.withColumn(KEY, own), KEY, self.order)
        held = None
        try:
            for _ in range(TRIES):
                now = self.manifest()
                if now["data"] and held is None:
                    # read several times from here on; a lost executor must not cost the feed's scan again
                    held = incoming = written(incoming, "incoming")
                attempt = f"{now['version'] + 1:08d}-{uuid.uuid4().hex}"
                published = self._prepare(now, incoming, attempt)
                if self.files.write_new(f"{self.path}/manifest/{published['version']:08d}.json", json.dumps(published)):
                    self._forget()
                    return published["version"]
                for kind in ("data", "index"):
                    self.files.delete(f"{self.path}/{kind}/{attempt}")
            raise RuntimeError(f"another writer was faster {TRIES} times in a row")
        finally:
            if held is not None:
                discard(held)

    def _prepare(self, now: dict, incoming: DataFrame, attempt: str) -> dict:
        """Everything an attempt writes, and the manifest that would make it visible."""
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in incoming.schema])
        schema = self._schema(now) if now["schema"] else plain
        hit: set[str] = set()
        found, winners = None, incoming
        if now["data"]:
            found = self._lookup(now, incoming.select(KEY))
            hit = {r["p"] for r in found.select(F.col(PERIOD).alias("p")).distinct().collect()}  # days, of which there is a bounded number
            # a part in too many folders is read with the rest and so put together again
            fresh = {r["p"] for r in incoming.select(self._period().alias("p")).distinct().collect()}
            hit |= {p for p in fresh if len(now["data"].get(p, [])) >= MAX_CHANGES}
            history = self._read("data", PERIOD, now["data"], hit, schema)
            winners = single_winners(history.unionByName(incoming.select(*schema.fieldNames())), KEY, self.order)
        # parts are split and put together by size at run time, so a day with a third of all messages has many writers
        winners.withColumn(PERIOD, self._period()).hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(f"{self.path}/data/{attempt}")
        fresh_data = self._parts("data", PERIOD, attempt)
        data = {p: a for p, a in now["data"].items() if p not in hit}
        data |= {p: [*data.get(p, []), attempt] for p in fresh_data}
        index = self._file(now, incoming.select(KEY), found, self._read("data", PERIOD, {p: [attempt] for p in fresh_data}, None, schema), attempt)
        return {"version": now["version"] + 1, "schema": json.loads(schema.json()), "data": data} | index

    def _slot(self, slots: int) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(slots)).cast("string")

    _ENTRY = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(PERIOD, T.StringType()), T.StructField(SEQ, T.LongType())])

    @staticmethod
    def _latest(entries: DataFrame) -> DataFrame:
        return entries.groupBy(KEY).agg(F.max(F.struct(SEQ, PERIOD)).alias("_e")).select(KEY, F.col(f"_e.{PERIOD}").alias(PERIOD), F.col(f"_e.{SEQ}").alias(SEQ))

    def _lookup(self, now: dict, keys: DataFrame) -> DataFrame:
        """Where the store has the given identifiers: the last entry of each."""
        touched = {r["s"] for r in keys.select(self._slot(now["slots"]).alias("s")).distinct().collect()} if now["slots"] > 1 else None
        return self._latest(self._read("index", SLOT, now["index"], touched, self._ENTRY).join(keys, KEY, "left_semi"))

    def _file(self, now: dict, keys: DataFrame, found: DataFrame | None, stored: DataFrame, attempt: str) -> dict:
        """Write the index entries that changed; slots with too many folders are written whole, all of them when slots double."""
        seq = F.lit(now["version"] + 1).cast("long")
        entries = stored.select(KEY, self._period().alias(PERIOD), seq.alias(SEQ))
        known = now["entries"]
        if found is None:
            added = stored.count()
        else:
            known_of = found.select(KEY, F.col(PERIOD).alias("_was"))
            # only identifiers of this batch can be new or have moved
            entries = entries.join(keys, KEY, "left_semi").join(known_of, KEY, "left").filter(~F.col("_was").eqNullSafe(F.col(PERIOD)))
            added = entries.filter("_was IS NULL").count()
            entries = entries.drop("_was")
        slots = now["slots"]
        while (known + added) > slots * SLOT_ENTRIES:
            slots *= 2
        whole = None if slots != now["slots"] else {s for s, a in now["index"].items() if len(a) >= MAX_CHANGES}
        old = self._read("index", SLOT, now["index"], whole, self._ENTRY)
        if now["index"] and (whole is None or whole):
            entries = self._latest(old.unionByName(entries))
        entries.withColumn(SLOT, self._slot(slots)).hint("rebalance", SLOT).write.partitionBy(SLOT).parquet(f"{self.path}/index/{attempt}")
        kept = {} if whole is None else {s: a for s, a in now["index"].items() if s not in whole}
        index = kept | {s: [*kept.get(s, []), attempt] for s in self._parts("index", SLOT, attempt)}
        return {"index": index, "slots": slots, "entries": known + added}

    def _parts(self, kind: str, part: str, attempt: str) -> list[str]:
        names = self.files.names(f"{self.path}/{kind}/{attempt}")
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{part}=")]

    # -- cleaning --------------------------------------------------------------------------------------------------
    @staticmethod
    def _folders(manifest: dict) -> set[str]:
        return {f"{kind}/{a}/{part}={p}" for kind, part in (("data", PERIOD), ("index", SLOT)) for p, attempts in manifest[kind].items() for a in attempts}

    def _forget(self) -> None:
        """Delete what only versions beyond the kept ones need."""
        names = self._versions()
        if len(names) <= KEEP_VERSIONS:
            return
        kept = [json.loads(self.files.read(f"{self.path}/manifest/{n}")) for n in names[-KEEP_VERSIONS:]]
        needed = set().union(*map(self._folders, kept))
        attempts = set(map(_attempt, needed))
        for n in names[:-KEEP_VERSIONS]:
            old = self._folders(json.loads(self.files.read(f"{self.path}/manifest/{n}"))) - needed
            for f in {f if _attempt(f) in attempts else _attempt(f) for f in old}:
                self.files.delete(f"{self.path}/{f}")
            self.files.delete(f"{self.path}/manifest/{n}")

    def vacuum(self, age: float = ORPHAN_AGE) -> list[str]:
        """Delete folders that no kept version names and that are older than ``age`` seconds: what dead writers left."""
        needed = {_attempt(f) for n in self._versions() for f in self._folders(json.loads(self.files.read(f"{self.path}/manifest/{n}")))}
        gone = []
        for kind in ("data", "index"):
            for a in self.files.names(f"{self.path}/{kind}"):
                f = f"{kind}/{a}"
                if f not in needed and time.time() - self.files.modified(f"{self.path}/{f}") >= age:
                    self.files.delete(f"{self.path}/{f}")
                    gone.append(f)
        return gone


def ingest_in_batches(store: OnceStore, feed: DataFrame, batch: str, at: str, versions: int) -> None:
    """Take a whole feed in as ``versions`` groups of its batches, oldest first; no batch is torn apart.

    A batch belongs to the group of its earliest ``at``. Rows without a batch, and batches without a time, are in the first.
    """
    lo, hi = feed.agg(F.min(F.unix_micros(at)), F.max(F.unix_micros(at))).first()
    if lo is None or versions <= 1:
        store.ingest(feed)
        return
    step = (hi - lo) // versions + 1
    number = F.floor((F.unix_micros(F.min(at)) - F.lit(lo)) / F.lit(step))
    groups = written(feed.groupBy(batch).agg(F.coalesce(number, F.lit(0)).alias("_group")), "batches")
    try:
        for n in range(versions):
            part = groups.filter(F.col("_group") == n).select(F.col(batch).alias("_batch"))
            rows = feed.join(part, F.col(batch) == F.col("_batch"), "left_semi")
            store.ingest(rows if n else rows.unionByName(feed.filter(F.col(batch).isNull())))
    finally:
        discard(groups)
