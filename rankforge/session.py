"""Session settings and the shared scratch location.

The engine pins the session time zone to UTC: epoch conversion, ``date_format`` and the
timestamp casts of the silver/gold layers depend on it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A batch commits its changes, not whole snapshots, and does not look up every key to count keys.
STATE_SETTINGS = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                  "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rankforge") -> SparkSession:
    """Session for tests and the bench. On a cluster use the cluster's own builder and call
    :func:`prepare`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # keyed streaming state (one row per key, no watermark) lives off-heap
        STATE_STORE: ROCKSDB,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.update({
            # a file stream hands each batch its new files as explicit paths; their status
            # is fetched by a listing job of up to one task per file -- keep it to a few
            # tasks on one machine (a cluster runs them in parallel anyway)
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "16",
            # opening a local file costs about as much as reading a few KB, not the 4 MB
            # the default assumes (an object-store request): pack more one-document files
            # into a read partition, so a pull is read and written as fewer, larger files
            "spark.sql.files.openCostInBytes": str(1024 * 1024),
        })
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone; keep streaming state off-heap unless another store is chosen; make
    sure a shared checkpoint folder is known."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    if not spark.conf.get(STATE_STORE, None) or spark.conf.get(STATE_STORE).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    for name, value in STATE_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a folder that all its machines share); without it every executor would
    write to its own disk, so anything but a local master is an error then. In local mode, as
    in tests, a temporary folder is made when it is unset.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        root = tempfile.mkdtemp(prefix="rankforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder; Spark's writers create it."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
    return f"{root}/rankforge/{leaf}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
