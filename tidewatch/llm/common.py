"""What several operators of this package need: stage tables, row keys, word lists and link components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_tidewatch_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidewatch-")) / "tidewatch_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidewatch_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a folder of this machine serves only a session in one process (``local[n]``);
    a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def table(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: what follows neither recomputes it nor depends
    on an executor that held part of it. ``codec`` names a Parquet compression other than the session's."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidewatch/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    # Spark removes a finished query's shuffle files once the JVM has found that nothing refers to them.
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Removes the files of a :func:`table` that later results no longer read."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tidewatch/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def text_of(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """128 bits that stand for a text, as 16 bytes."""
    return F.unhex(F.md5(text_of(name)))


def private(df: DataFrame, name: str) -> str:
    """A name for a column of an operator's own that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name


def id_bucket(name: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus
