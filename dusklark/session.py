"""Session helpers: where durable intermediate results go, and how tables are found."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Schemes whose renames are copies, so that only a conditional put is exclusive.
_OBJECT_STORES = {"s3a", "s3", "gs", "oss", "cosn"}


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dusklark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only where that setting is absent on one machine (tests) a temporary folder is made and set; a cluster without it is refused.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="dusklark-")
        spark.conf.set(CHECKPOINT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_scratch: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, deleted at the end of this process if not before."""
    path = f"{shared_dir(spark)}/dusklark/{label}-{uuid.uuid4().hex}"
    _scratch[path] = spark
    return path


@atexit.register
def clear_scratch() -> None:
    """Delete what :func:`scratch` gave out; nothing read from it is of use afterwards."""
    for path, spark in list(_scratch.items()):
        _scratch.pop(path, None)
        try:
            SharedFiles(spark, path).delete(path)
        except Exception:  # noqa: BLE001 - the session has ended before this process
            return


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the caller only put it on its own path."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder, so that a lost executor costs no recomputation upstream."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._dusklark_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`written` that nothing will read any more."""
    path = table._dusklark_path
    SharedFiles(table.sparkSession, path).delete(path)
    _scratch.pop(path, None)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly where a scan has fewer parts than the cluster has cores; for work that costs far more than a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


class SharedFiles:
    """The few file operations that publishing a version needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._scheme = self._fs.getUri().getScheme()
        self._jvm = jvm

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def write_new(self, path: str, text: str) -> bool:
        """Create a file exclusively: readers see the whole of it or none. False if the target is there already, or appears meanwhile."""
        if self.exists(path):
            return False
        if self._scheme in _OBJECT_STORES:
            return self._put_new(path, text)
        side = self._beside(path, text)
        try:
            if self._scheme != "file":
                return bool(self._fs.rename(self._path(side), self._path(path)))
            # a rename replaces its target here; a link is refused if the name is taken
            os.link(self._local(side), self._local(path))
            return True
        except FileExistsError:
            return False
        finally:
            self.delete(side)

    def _put_new(self, path: str, text: str) -> bool:
        """One conditional put: an object appears whole when it is closed, and only if there was none."""
        out = self._fs.createFile(self._path(path)).overwrite(False).opt("fs.option.create.conditional.overwrite", True).build()
        out.write(bytearray(text.encode("utf-8")))
        try:
            out.close()
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise
        return True

    def replace(self, path: str, text: str) -> None:
        """Write beside the target and put it in its place in one step, whether there was one or not."""
        side = self._beside(path, text)
        if self._scheme == "file":
            os.replace(self._local(side), self._local(path))
            return
        option = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(option.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(options, 0, option)
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf()).rename(self._path(side), self._path(path), options)

    def _beside(self, path: str, text: str) -> str:
        side = f"{path}.{uuid.uuid4().hex}.tmp"
        if self._scheme == "file":
            os.makedirs(os.path.dirname(self._local(side)), exist_ok=True)
            Path(self._local(side)).write_text(text, encoding="utf-8")
            return side
        out = self._fs.create(self._path(side), False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return side

    def _local(self, path: str) -> str:
        return self._path(path).toUri().getPath()

    def modified(self, path: str) -> float:
        """Seconds since 1970 at which a path was last changed."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
