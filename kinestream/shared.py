"""Tables in the folder that the driver and all executors see."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders of applications on one machine that name none, by application: the setting can't be changed in a running session.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where an application on one machine names none, it gets a temporary one for as long as this process runs. On a cluster that is an error: executors
    would each write to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} see")
        name = spark.sparkContext.applicationId
        if name not in _OWN:
            _OWN[name] = tempfile.mkdtemp(prefix="spark-shared-")
            atexit.register(shutil.rmtree, _OWN[name], ignore_errors=True)
        found = _OWN[name]
    return found.rstrip("/")


def tables_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one, for tables between steps."""
    return f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}"


def _cleared_at_exit(spark: SparkSession) -> None:
    """Tables between steps go with the session that made them, also where nobody calls ``clear``."""
    context = spark.sparkContext
    if getattr(context, "_kinestream_clears", False):
        return
    context._kinestream_clears = True
    stop = context.stop

    def stopped() -> None:
        with contextlib.suppress(Exception):  # a session that is broken can't delete
            clear(spark)
        stop()

    context.stop = stopped


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: what was costly is computed once, its lineage is cut and survives lost executors."""
    _cleared_at_exit(df.sparkSession)
    path = f"{tables_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's tables between steps. Results that were made of them and not written are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
