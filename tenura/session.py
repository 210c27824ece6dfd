"""Session settings shared by the tests, the benchmark and the command-line runs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: int | str = 8, app: str = "tenura") -> SparkSession:
    """A single-machine session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a session within one process gets one of its own if it names none.

    A cluster that names none is refused: a machine's own folder is not shared by its executors.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("Name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="tenura-")
        context.setCheckpointDir(named)
    return named


def shared_table(df: DataFrame) -> DataFrame:
    """Cut lineage: write the table to the shared folder and read it back.

    Later passes survive lost executors, scan only their columns, and start from a short plan.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting; beyond ``max_rows`` Spark picks the join itself.

    The counted table is kept, so the check does not compute it twice.
    """
    kept = df.persist()
    return F.broadcast(kept) if kept.count() <= max_rows else kept
