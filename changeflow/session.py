"""Session helpers: builder defaults and reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Catalogs at or below this number of tables may be broadcast; their size is known on the driver.
BROADCAST_ROWS = 100_000


def get_session(app: str = "changeflow", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings the operators expect."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the decoders rely on; safe to call on any session."""
    # GBK and other JVM charsets in decode()
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    # a column named twice in one message: the later value counts
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; only local sessions may fall back to a temp folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that iterative plans stay short and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

