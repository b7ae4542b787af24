"""Session helpers: the Spark session, table access and shared storage.

Nothing here keeps state between sessions except the list of tables written by
:func:`materialize`, which are removed when the Python process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()


def get_spark(app: str = "quernstone", master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings every operator expects (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Workers unpickle functions of this package; on a cluster nothing else puts
    it on their path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quernstone-")) / "quernstone_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    It is the one named in ``spark.checkpoint.dir``, else the checkpoint folder
    of the context. Only a local session (tests) may have neither and use a
    temporary folder of this machine; on a cluster that raises, as executors
    would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="quernstone-")
    return _OWN_DIRS[app]


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The copy survives the loss of executors, and its size is known to the
    planner. It is deleted when the process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quernstone/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        for item in list(_WRITTEN):
            if path.split("/quernstone/")[-1] == item[1].split("/quernstone/")[-1]:
                _remove(*item)
                _WRITTEN.remove(item)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for item in _WRITTEN:
        try:
            _remove(*item)
        except Exception:  # the session may be gone already
            pass
    _WRITTEN.clear()
    for path in _OWN_DIRS.values():
        import shutil

        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
