"""Session helpers: a configured local session for tests/bench, and the shared checkpoint folder.

Operators that need a stable intermediate (dense row ids, exact medians) write it under the
folder the cluster names in ``spark.checkpoint.dir``. The setting is read from the session; a
private folder is only created when it is unset *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

_CKPT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "featurepipe", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session tuned for small test data: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only for an unset local session."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(_CKPT_CONF, None) or sc.getConf().get(_CKPT_CONF, None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):       # local-cluster has executors of its own
            raise RuntimeError(
                f"{_CKPT_CONF} is not set; set it to a folder every executor can reach "
                "(HDFS/S3/ABFS path) so stable intermediates survive executor loss")
        conf_dir = tempfile.mkdtemp(prefix="featurepipe-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_MATERIALIZED: dict[str, list[str]] = {}


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


def keep_until_release(spark: SparkSession, path: str) -> None:
    """Count the folder ``path`` among the intermediates: it goes with them, at the latest when the
    application ends."""
    _MATERIALIZED.setdefault(spark.sparkContext.applicationId, []).append(path)
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hp)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """``materialized`` without the folder's name."""
    return materialized(df, name)[0]


def materialized(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the checkpoint folder; the re-read frame and the folder.

    Cuts lineage (a lost executor re-reads files instead of recomputing a non-deterministic
    shuffle) and lets later passes read only the columns they need. The folder is an intermediate:
    see ``release_materialized`` and ``only_result``.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, "featurepipe", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    keep_until_release(spark, path)
    return spark.read.parquet(path), path


def release_materialized(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> int:
    """Delete this application's intermediates (call once every frame built on them has been
    written), of those made after the first ``since`` and without the folders ``keep``. Returns the
    number of folders removed."""
    held = _MATERIALIZED.get(spark.sparkContext.applicationId, [])
    gone = [p for p in held[since:] if p not in keep]
    held[since:] = [p for p in held[since:] if p in keep]
    _delete(spark, gone)
    return len(gone)


def intermediates(spark: SparkSession) -> int:
    """Number of intermediate folders at present: the mark that ``release_materialized`` takes."""
    return len(_MATERIALIZED.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, path: str) -> None:
    """Delete one intermediate folder."""
    _MATERIALIZED[spark.sparkContext.applicationId].remove(path)
    _delete(spark, [path])


def newest(spark: SparkSession) -> str:
    """The intermediate folder made last."""
    return _MATERIALIZED[spark.sparkContext.applicationId][-1]


def only_result(spark: SparkSession, build: Callable[[], DataFrame], name: str = "result") -> DataFrame:
    """The frame of ``build()``, written and read again, with all intermediates that it made deleted."""
    mark = intermediates(spark)
    out, path = materialized(build(), name)
    release_materialized(spark, mark, keep=[path])
    return out


def stable(df: DataFrame) -> DataFrame:
    """Reliable (shared-folder) checkpoint of a small frame, eager."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` when a count proves it has at most ``max_rows`` rows (one small job on a
    per-group table); otherwise return it unchanged and let AQE plan (and de-skew) the join.

    Used where the join key is itself a hot group (a split, a class label): a shuffle join on
    such a key would send a whole group to one task, a broadcast join sends none."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.count() <= max_rows else df
