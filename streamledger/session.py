"""Session construction, shared scratch locations and small filesystem helpers.

Scratch data (wire directories, stream checkpoints, ingested tables written by the
registered queries) lives under the shared folder named by ``spark.checkpoint.dir``.
Without it a folder of our own is picked on a local master only, as in unit tests; on a
cluster that is an error.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "streamledger",
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests and the bench: AQE on, UTC, no UI."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # MIN/MAX/COUNT without filters answered from Parquet footers (status queries)
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set one only where unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not a session conf
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streamledger-ckpt-")  # one machine, as in tests
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)  # so Dataset.checkpoint() writes to the same shared folder
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/streamledger/{name}-{uuid.uuid4().hex[:12]}"


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.delete(hpath, recursive))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """File and folder names directly under ``path`` (metadata only)."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs_and_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless it exists; says whether it was created.

    The content is written beside it and renamed without replacing, which one of several
    writers wins on file systems whose rename is atomic (HDFS, most cloud file systems with a
    hierarchical namespace)."""
    part = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
    write_text(spark, part, text)
    jvm = spark.sparkContext._jvm
    fs, hpart = _fs_and_path(spark, part)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpart.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep_old = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(hpart, jvm.org.apache.hadoop.fs.Path(path), keep_old)
        return True
    except Py4JJavaError as why:
        fs.delete(hpart, False)
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
            return False
        raise why


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (what ``--py-files`` does).

    The zip is written once per application under the shared checkpoint root and added
    with ``addPyFile``; pandas UDFs reference module-level helpers by name.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    local = tempfile.mkdtemp(prefix="streamledger-pkg-")
    zpath = os.path.join(local, "streamledger.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("streamledger", os.path.relpath(full, pkg_dir)))
    target = f"{checkpoint_root(spark)}/streamledger-pkg-{uuid.uuid4().hex[:12]}.zip"
    fs, hpath = _fs_and_path(spark, target)
    fs.copyFromLocalFile(True, True, sc._jvm.org.apache.hadoop.fs.Path(zpath), hpath)
    shutil.rmtree(local, ignore_errors=True)
    sc.addPyFile(target)
    _SHIPPED.add(app)
