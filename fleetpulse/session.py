"""Session settings and the shared folder for intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def get_spark(app: str = "fleetpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tested under.

    Sizes such as shuffle partitions and memory are left to the cluster unless
    given in ``conf`` (underscores stand for dots).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that survives executors: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a scratch folder of its own; a cluster session
    fails, since a machine-local folder would not be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="fleetpulse-")
    return _local_roots[app]


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage for frames that several later jobs read.
    """
    path = os.path.join(shared_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
