"""Shared plumbing: cutting lineage, checked broadcasts, shipping the package to executors."""

from __future__ import annotations

import atexit
import io
import os
import re
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes (as Spark lays rows out) up to which a side may be broadcast.
BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 64 << 20

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where that is unset and the master is local (tests), a temporary one, removed at exit; on a
    cluster it is an error, as a folder of one machine can't be read by the others.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        place = "file://" + local
        spark.conf.set("spark.checkpoint.dir", place)
    return place


def write_file(spark: SparkSession, place: str, data: bytes) -> None:
    """Write one file on any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data))
    out.close()


def read_file(spark: SparkSession, place: str) -> bytes | None:
    """The bytes of one file, None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    source = fs.open(path)
    data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    source.close()
    return data


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a file into the shared folder; its full path."""
    place = f"{shared_dir(spark).rstrip('/')}/{name}"
    write_file(spark, place, data)
    return place


def settle(df: DataFrame) -> DataFrame:
    """Materialise once and cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    place = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(place)
    return df.checkpoint(eager=True)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only if df has at most max_rows rows of at most max_bytes in all; otherwise df as it is, for a shuffled join.

    Counted and measured here on at most max_rows + 1 rows, by the width of each row's text and binary
    columns and eight bytes for any other. Callers pass settled or small data, so that this reads little.
    """
    wide = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    width = sum(wide, F.lit(16 + 8 * len(df.columns)))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def ship(spark: SparkSession) -> None:
    """Put this package on the Python path of all workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(root):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("corpusmill", os.path.relpath(full, root)))
    sc.addPyFile(write_shared(spark, f"corpusmill-{sc.applicationId}.zip", packed.getvalue()))
