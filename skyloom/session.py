"""Session settings and the one place where lineage is cut."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("skyloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # lists of small groups are put together in memory instead of by a sort, up to so many groups a task
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "20000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, as in tests, one of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.skyloom.scratch", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        named = "file://" + tempfile.mkdtemp(prefix="skyloom-")
        spark.conf.set("spark.skyloom.scratch", named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)
