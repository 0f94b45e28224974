"""Local session for tests and checks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


_folder: list[str] = []


def _shared_folder() -> str:
    """One folder for the intermediate tables of this process, removed at its end."""
    if not _folder:
        _folder.append(tempfile.mkdtemp(prefix="corpuslab-"))
        atexit.register(shutil.rmtree, _folder[0], ignore_errors=True)
    return f"file://{_folder[0]}"


def local_session(cpus: str | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName("corpuslab")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", _shared_folder())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
