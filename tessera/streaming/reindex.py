"""Incremental index: chunks that arrive as a stream become postings, a later state of a chunk replacing earlier ones.

Each micro-batch owns the files whose names begin with its id, which a replay after a restart replaces, so nothing counts
twice. Its keys are listed in a table beside it; reading the index takes of each key the postings of the last batch that has it. A chunk whose
text became null or empty is listed and has no postings, which removes it. Rows with a null key are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.search import postings


def keys_path(path: str) -> str:
    return path.rstrip("/") + ".keys"


def index_batch(batch: DataFrame, batch_id: int, path: str, key: str = "chunk_id", text: str = "text") -> None:
    """Write the term counts of a micro-batch; of repeated keys in it the largest text holds."""
    one = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(text).alias(text))
    _publish(postings(one, key, F.col(text)).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")), path, batch_id)
    _publish(one.select(key), keys_path(path), batch_id)


def _publish(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's rows beside the table, then move its files in under the batch's name."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.staging/b{batch_id}")
    fs = target.getFileSystem(conf)
    df.write.mode("overwrite").parquet(staged.toString())
    fs.mkdirs(target)
    for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(target, f"b{batch_id}-*")) or []:
        fs.delete(f.getPath(), False)
    for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(staged, "part-*")) or []:
        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(target, f"b{batch_id}-{f.getPath().getName()}"))
    fs.delete(staged, True)


def stream_index(chunks: DataFrame, path: str, checkpoint: str, key: str = "chunk_id", text: str = "text") -> StreamingQuery:
    """Start indexing a streaming table until it has no more data; restarts go on where the last run ended."""
    return chunks.writeStream.foreachBatch(lambda df, n: index_batch(df, n, path, key, text)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_index(spark: SparkSession, path: str, key: str = "chunk_id") -> DataFrame:
    """``(key, term, tf)``: the present state of the index."""
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/b(\d+)-[^/]*$", 1).cast("long")
    rows = spark.read.parquet(path).withColumn("batch", batch)
    last = spark.read.parquet(keys_path(path)).withColumn("batch", batch).groupBy(key).agg(F.max("batch").alias("batch"))
    return rows.join(last, [key, "batch"]).select(key, "term", "tf")


def search_index(index: DataFrame, terms: list[str], key: str = "chunk_id", k: int = 8) -> DataFrame:
    """``(place, key, score)``: the k rows of a read index with the highest BM25 score for the stated terms."""
    from pyspark.sql import Window

    from tessera.operators.search import B, K1

    length = index.groupBy(key).agg(F.sum("tf").alias("dl"))
    stats = length.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("mean"))
    hit = index.filter(F.col("term").isin(*sorted(set(terms))))
    df = hit.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    x = hit.join(F.broadcast(df), "term").join(length, key).crossJoin(F.broadcast(stats))
    idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("mean")))
    scored = x.groupBy(key).agg(F.round(F.sum(part), 6).alias("score")).orderBy(F.desc("score"), key).limit(k)
    return scored.select(F.row_number().over(Window.orderBy(F.desc("score"), key)).alias("place"), key, "score")
