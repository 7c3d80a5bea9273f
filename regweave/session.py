"""Session defaults and the few cluster settings the library reads.

Nothing here is needed on a cluster that already has a session: every operator
takes DataFrames.  ``local_session`` exists for tests and the benchmark.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the runtime work this library leans on: it re-plans a join to a
# broadcast only after measuring the side, splits skewed join partitions and
# coalesces small shuffle partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A ``local[n]`` session with the library defaults."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("regweave")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the cluster names in ``spark.checkpoint.dir``.

    A private folder is used only when the session names none, which is the case in tests.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    named = named or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="regweave-"))
        named = context.getCheckpointDir()
    return named


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and lets every later branch
    read only the columns it needs.  (``checkpoint()`` would compute the rows twice and
    keep them row-wise.)
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/regweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsized(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled whatever its estimated size.

    Spark sizes rows that were exploded, or read from well compressed files, far too low,
    and would send a large table through the driver to broadcast it.
    """
    return df.hint("merge")
