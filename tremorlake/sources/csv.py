"""CSV readings in and results out."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scratch import delete_path

# The column names under which the same reading is delivered.
COLUMN_VARIANTS = {
    "Timestamp": "timestamp",
    "Pos": "timestamp",
    "AccelerationX": "X",
    "AccelerationY": "Y",
    "AccelerationZ": "Z",
    "Value": "value",
    "Anomaly": "anomaly",
}


def sensor_schema(columns: Sequence[str] = ("timestamp", "X", "Y", "Z")) -> T.StructType:
    """First column text, the others double."""
    first, *rest = columns
    return T.StructType([T.StructField(first, T.StringType()), *[T.StructField(c, T.DoubleType()) for c in rest]])


def labelled_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("timestamp", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("anomaly", T.DoubleType()),
        ]
    )


def read_sensor_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = ("timestamp", "X", "Y", "Z"),
    header: bool = False,
    device_pattern: str | None = None,
) -> DataFrame:
    """Readings of one or many files (``.csv`` or ``.csv.gz``) as one table.

    ``device_pattern`` is a regular expression with one group that finds the device number in the
    file name, such as ``EDS_(\\d+)``. A plain file is split over many tasks, a ``.gz`` is not.
    """
    df = spark.read.schema(sensor_schema(columns)).option("header", header).csv(path)
    if device_pattern:
        number = F.regexp_extract(F.col("_metadata.file_path"), device_pattern, 1)
        df = df.withColumn("device_id", number.try_cast("int"))
    return df


def read_header_csv(spark: SparkSession, path: str | list[str], types: Mapping[str, str]) -> DataFrame:
    """CSV with a header row: the named columns, cast explicitly; text that does not fit is NULL."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def read_labelled_csv(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    df = spark.read.schema(labelled_schema()).option("header", header).csv(path)
    return df.withColumn("anomaly", F.col("anomaly").cast("int"))


def normalise_columns(df: DataFrame, variants: Mapping[str, str] = COLUMN_VARIANTS) -> DataFrame:
    """One set of column names, whichever naming the file uses."""
    return df.withColumnsRenamed({k: v for k, v in variants.items() if k in df.columns})


def write_sorted_csv(
    df: DataFrame, path: str, order: Sequence[str], header: bool = False, single_file: bool = False
) -> None:
    """Rows in order across the part files, or in one file.

    One file is joined from parts that all executors write, in their order.
    """
    ordered = df.orderBy(*order)
    if not single_file:
        ordered.write.mode("overwrite").csv(path, header=header)
        return
    spark, parts = df.sparkSession, f"{path.rstrip('/')}/_parts"
    delete_path(spark, path)
    ordered.write.csv(parts)
    line = io.StringIO()
    if header:
        csv.writer(line, lineterminator="\n").writerow(df.columns)
    join_files(spark, parts, f"{path.rstrip('/')}/part-00000.csv", line.getvalue().encode())
    delete_path(spark, parts)


def join_files(spark: SparkSession, folder: str, target: str, head: bytes = b"") -> None:
    """One file of ``head`` and the part files of ``folder`` in the order of their names.

    A file system that can concatenate does so without moving a byte; elsewhere the bytes are copied through a small
    buffer, and no row is read.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    files = [f for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-") and f.getLen() > 0]
    sources = sorted((f.getPath() for f in files), key=lambda p: p.getName())
    out = fs.create(path(target), True)
    out.write(bytearray(head))
    out.close()
    if not sources:
        return
    if head:  # a target with bytes of its own can be concatenated to
        array = spark.sparkContext._gateway.new_array(path, len(sources))
        for i, p in enumerate(sources):
            array[i] = p
        try:
            fs.concat(path(target), array)
            return
        except UnsupportedOperationException:
            pass
    out = fs.create(path(target), True)
    try:
        out.write(bytearray(head))
        for p in sources:
            part = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
    finally:
        out.close()


def export_csv(df: DataFrame, path: str) -> None:
    """A result table with its header, written by the executors."""
    df.write.mode("overwrite").csv(path, header=True)
