"""Helpers shared by the operators: the driver tables, intermediate tables, words."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.sources.layers import shared_folder

#: White space of the contracts, as Java, Python and DuckDB patterns all read it.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()
#: Rows that go to Python at once, where the session has Spark's default: whole texts are long, and a
#: batch is held by the executor, by Arrow and by Python.
BATCH_ROWS, DEFAULT_ROWS = "1000", "10000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession | None = None) -> None:
    """Sends this package to the executors, once for each application, so that Python functions find
    it there however the driver was started, and makes the session's batches small."""
    spark = spark or SparkSession.active()
    if spark.conf.get(_BATCH) == DEFAULT_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # A file of the driver's own, which Spark hands to every executor.
    archive = os.path.join(tempfile.mkdtemp(prefix="trustmart-code-"), "trustmart_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that every executor sees; it goes when the driver ends."""
    folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut, and an executor that is
    lost later costs nothing."""
    spark = df.sparkSession
    folder = scratch(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def words(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased: bytes split at and lower-case ASCII only."""
    return text.encode("utf-8").lower().split()
