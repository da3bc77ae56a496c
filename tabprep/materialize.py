"""The shared folder of the session, and cutting lineage through it."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this session, which all executors reach.

    It is ``spark.checkpoint.dir``. A folder of our own is made only for a local
    session that names none.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tabprep-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there goes when the session ends."""
    parent = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{parent}/data"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete what was written at a path that ``new_folder`` gave."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` below the checkpoint folder and read it back from there.

    Used where values that depend on the physical layout (partition numbers) must
    become plain data before they are used twice; the copy survives lost executors and goes when the session ends.
    """
    folder = new_folder(df.sparkSession, "rows")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
