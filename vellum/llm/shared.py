"""Table access and lineage cuts shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch, after the row that goes beyond; by default Spark packs 10,000 whole texts.
BATCH = 4 << 20


def bounded(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold about BATCH bytes, unless it has a bound of its own: they are held once
    by the executor and some times by each Python worker.  No result depends on how texts are batched."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name, read by Spark so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session has none and runs on one machine, as in tests, a
    temporary folder is made and recorded in the session, so that later calls
    find it too; on a cluster that would lose data, so there it is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = f"file://{tempfile.mkdtemp(prefix='vellum-')}"
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/vellum/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage: a lost executor costs a reread, never a rerun, and
    Python passes run once although several consumers follow.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of the shared folder that last as long as an operator works: ``with Scratch(spark) as s: s.table(df, label)``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """As :func:`materialize`; the table goes with the scratch."""
        path = new_dir(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def tidy(self) -> None:
        """Let go of the files of shuffles that have ended: they stay until the driver's JVM collects what refers to them, which a large heap may put off."""
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, keep: int = 0) -> None:
        """Remove all tables but the last ``keep``."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        gone, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        for path in gone:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
