"""JSON lines: lenient and strict readers, and a writer that reports its number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.session import checkpoint


class MalformedRows(ValueError):
    """A strict read met lines that are no JSON objects of the schema."""


def read_lenient(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parsed rows with their raw line; raises ``MalformedRows`` with file, line number and text if any line is malformed.

    The source is read and parsed once into a written table; line numbers are looked up only for the lines at fault.
    """
    lines = spark.read.text(path).withColumn("file", F.input_file_name()).filter(F.trim("value") != "")
    corrupt = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = checkpoint(lines.select("file", F.col("value").alias("raw"), F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}).alias("row")))
    bad = parsed.filter("row IS NULL OR row._corrupt IS NOT NULL").select("file", "raw").limit(3).collect()
    if bad:
        raise MalformedRows("; ".join(f"{r.file}:{_line_number(spark, r.file, r.raw)}: {r.raw[:80]}" for r in bad))
    return parsed.select("raw", *(F.col(f"row.{f.name}").alias(f.name) for f in schema.fields))


def _line_number(spark: SparkSession, file: str, line: str) -> int:
    """Number of the first line of a file that reads like this; partitions of one file come in its order."""
    found = spark.sparkContext.textFile(file).zipWithIndex().filter(lambda x: x[0] == line).take(1)
    return found[0][1] + 1 if found else 0


def write_rows(df: DataFrame, path: str) -> int:
    """Write one JSON object a line and return the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return int(seen.get["n"])


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty one of the schema where nothing lies there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return read_lenient(spark, path, schema)
