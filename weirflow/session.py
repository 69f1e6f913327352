"""Settings for a session of a given input and cluster."""

from __future__ import annotations


def settings(input_gb: float, cores: int) -> dict[str, str]:
    """Spark settings so that a shuffled partition is some 128 MB and no core is idle.

    Adaptive execution joins what stays smaller and splits what is skewed; Arrow batches are small enough for whole
    texts. Nothing here changes a result.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(max(2 * cores, round(input_gb * 8))),
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def builder(app: str = "weirflow", input_gb: float = 1.0, cores: int = 8):
    """A session builder with these settings; what the cluster sets beforehand may be overridden by ``.config``."""
    from pyspark.sql import SparkSession

    out = SparkSession.builder.appName(app)
    for k, v in settings(input_gb, cores).items():
        out = out.config(k, v)
    return out
