"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separator of words in all operators here.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A column named twice inside a lambda may be inlined by the optimizer and then runs once
    per array element; a lambda variable never is.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of this cluster; where none is set, a local session (tests) takes a temporary one.

    A cluster without it raises: its executors share no local folder.
    """
    directory = spark.conf.get("spark.checkpoint.dir", None)
    if not directory:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        directory = tempfile.mkdtemp(prefix="colloquia-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", directory)
    return directory


def written(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it again: lineage is cut reliably."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/colloquia/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove all tables that ``written`` left in the shared folder; call it once their results are stored elsewhere."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/colloquia")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
