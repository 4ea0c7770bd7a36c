"""Session settings that the operators rely on."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

#: Adaptive plans merge small shuffle partitions and split skewed ones; timestamps are UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local(threads: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench."""
    conf = SETTINGS | {"spark.sql.shuffle.partitions": str(threads), "spark.ui.enabled": "false", "spark.driver.memory": "8g"} | extra
    spark = SparkSession.builder.master(f"local[{threads}]").appName("tickloom").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def python_ready(spark: SparkSession) -> None:
    """Let Python workers find this package wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)
