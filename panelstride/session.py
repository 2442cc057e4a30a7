"""Spark session and storage helpers.

Cluster settings always win: nothing here overrides a value the session
already carries. Local defaults exist only so tests and the bench can start
a session on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  driver_memory: str = "16g", app_name: str = "panelstride") -> SparkSession:
    """Session for tests and the bench (``local[cores]``)."""
    warehouse = tempfile.mkdtemp(prefix="panelstride-wh-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.warehouse.dir", warehouse)
    )
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    keep_compiled(spark)
    shared_folder(spark)
    return spark


#: Generated methods above this size are never compiled by the JVM, however often they run.
JIT_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def keep_compiled(spark: SparkSession) -> None:
    """Stages whose generated code is one method too long to be compiled run operator by
    operator instead, in methods that are. A value the session carries stays."""
    key, limit = JIT_LIMIT
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, limit)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, wherever they run: it goes to the
    executors as a zip, once for each application (as ``--py-files`` would do)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="panelstride-code-")) / "panelstride_code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, as it stands there
    (the same in every session, so that what lies in it can be found again).

    Only a one-machine ``local`` session may go without the setting and gets a
    temporary folder; any other session must name a folder all its machines share.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="panelstride-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Whether Spark removes a finished execution's shuffle files, which else stay on disk until the
#: driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind: what is written is not computed again
    from them. Only for writes, whose executions nothing reads a second time. A value the
    session carries stays."""
    if DROP_SHUFFLES in spark.conf.getAll:
        yield
        return
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES)


#: Scratch tables are written once and read a few times: small files count more than the
#: writer's time.
CODEC = "zstd"


def shared_table(df: DataFrame, name: str, codec: str | None = CODEC) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back: cuts the
    lineage, so later steps neither recompute it nor depend on any executor's memory.
    Its shuffles are gone when it stands; with ``codec=None`` they are left to Spark, and
    the session's codec holds."""
    path = f"{shared_folder(df.sparkSession)}/panelstride/{name}-{uuid.uuid4().hex[:12]}"
    if codec is None:
        df.write.parquet(path)
    else:
        with shuffles_dropped(df.sparkSession):
            df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def moved_table(df: DataFrame, name: str) -> DataFrame:
    """A :func:`shared_table` in the place of those that ``df`` reads: these are removed, so
    ``df`` itself is not to be read again."""
    table = shared_table(df, name)
    drop_tables_of(df)
    return table


def drop_tables_of(df: DataFrame) -> None:
    """Remove the files of the :func:`shared_table` results that ``df`` reads, once what is made
    of it has been written and nothing will read them any more. Files elsewhere stay."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    scratch = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/panelstride").toUri().getPath()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if path.getParent().toUri().getPath() == scratch:
            path.getFileSystem(conf).delete(path, True)
