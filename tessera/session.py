"""Session helpers: package shipping, checkpointing and run-scoped settings."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()
_tables: list[tuple[SparkSession, str]] = []


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Nothing is done where all workers run on this machine and inherit a path that holds it; otherwise a zip of the
    sources is added to the session once per application, which the executors fetch from the driver.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep) + ([os.getcwd()] if sc.master.startswith("local[") or sc.master == "local" else [])
    if app in _shipped or sc.master.startswith("local") and any(p and Path(p).resolve() == _ROOT for p in paths):
        return
    target = Path(tempfile.mkdtemp()) / "tessera_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((_ROOT / "tessera").rglob("*.py")):
            z.write(f, f.relative_to(_ROOT))
    sc.addPyFile(str(target))
    _shipped.add(app)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; it goes like the tables of ``checkpoint``."""
    path = f"{_folder(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _remember(spark, path)
    return path


def _remember(spark: SparkSession, path: str) -> None:
    if not _tables:
        atexit.register(_drop_tables)
    _tables.append((spark, path))


def _folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a table written into the shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset and everything runs on this machine
    (tests, notebooks) is a temporary one chosen, elsewhere it is an error. A table is used rather than a checkpointed plan because its real size, not the product of the estimates of
    all joins before it, is what later rounds of an iterative operator are planned with. Tables go with ``release`` or when the application ends.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/tessera-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _remember(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables written by ``checkpoint`` that no later result reads."""
    for df in tables:
        path = getattr(df, "_tessera_path", None)
        if path:
            _delete(df.sparkSession, path)
            _tables[:] = [t for t in _tables if t[1] != path]


def release_all(spark: SparkSession) -> None:
    """Delete all tables written so far: for long sessions, once their results have been stored."""
    for s, path in [t for t in _tables if t[0] is spark]:
        _delete(s, path)
    _tables[:] = [t for t in _tables if t[0] is not spark]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_tables() -> None:
    for spark, path in _tables:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
