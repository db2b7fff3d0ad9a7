"""Session used by the tests and by bench.py; a deployment brings its own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "8", app: str = "tremorlake") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TREMORLAKE_DRIVER_MEMORY", "12g"))
        # One machine, so its own folder is shared; a cluster names one that all executors see.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tremorlake-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
