"""Session helpers: defaults for local runs and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, app="gridledger"):
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark, label):
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Without that setting a local session takes a temporary folder; a cluster
    session is refused, as its executors share no local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="gridledger-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
