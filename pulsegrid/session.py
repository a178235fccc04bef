"""Session settings this engine is meant to run with, and its shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated member of a JSON object takes the last value; validation relies on it.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # HotSpot interprets methods of more than 8000 bytecodes. A stage whose generated
    # loop outgrows that runs faster as separate operators, whose code is split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "8", name: str = "pulsegrid", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Where a local session that names no shared folder (as in tests) keeps its intermediate data.
LOCAL_WORK = "/tmp/pulsegrid"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach, for checkpoints and intermediate tables.

    The cluster names the shared place in ``spark.checkpoint.dir``. Only where
    that is unset a local session takes its own; a cluster must name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = LOCAL_WORK
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
