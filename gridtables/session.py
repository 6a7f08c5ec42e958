"""Session settings the library is written for.

Nothing here is required: every operator works on any session. The settings only make
adaptive execution split skewed join sides and keep partitions small enough to spill cheaply.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even where that costs one more exchange later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoint files go when the plans that read them do
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # long rule expressions are built several times faster without call-site tracking
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "gridtables", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Actions in here run no generated method of more than 8,000 bytes, which the JVM would only interpret: Spark then splits the
    expressions of that stage into methods that are compiled."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "8000")
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder of its own; a cluster, where such a folder would be lost
    with its machine, must name one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_folder(spark))
    return df.checkpoint()


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="gridtables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return folder


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """Like ``cut_lineage``, as a Parquet table: each reader takes only its columns and partitions. The folder's owner removes it."""
    spark = df.sparkSession
    folder = f"{_shared_folder(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
