"""One place for the session's settings and for shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def session(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with ANSI casts and adaptive execution; conf overrides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | {k.replace("__", "."): str(v) for k, v in conf.items()}
    return b.config(map=settings).getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir); a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="millrace-"))
        root = _OWN[0]
    return f"{root.rstrip('/')}/scratch/{uuid.uuid4().hex}-{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt by a key over all cores, for work that is large though its input is small.

    Adaptive execution puts what is small in bytes into one task, whatever a row costs there.  Groups and joins
    by the key need no other exchange.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)
