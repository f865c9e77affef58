"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tallyhouse.sources.storage import Storage

_local_folders: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}


def build_session(
    master: str = "local[8]", app: str = "tallyhouse", driver_memory: str = "12g", **extra: str
) -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    cores = master[6:-1] if master.startswith("local[") else "8"
    settings = {
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": driver_memory,
    } | extra
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if named.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names a machine's own disk; executors cannot share it")
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses.

    Paths are grouped by application, so what a crashed job left behind can be told apart.
    """
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/tallyhouse/{app}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(app, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every path ``fresh_path`` gave to this session; returns how many existed.

    To be called once the results have been written: frames that read such a path end with it.
    """
    removed = 0
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        store = Storage(spark, path)
        if store.exists(path):
            store.remove(path)
            removed += 1
    return removed


def fresh_name(label: str) -> str:
    """A table name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex[:12]}"
