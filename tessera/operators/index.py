"""A stored lexical index: postings of stems in buckets of terms, its state, and BM25 search that reads its own terms only.

An index is a folder with three tables: ``postings`` (term, key, dl, positions), partitioned by a hash of the term so that
a search opens the buckets of its words and nothing else; ``corpus`` (key, sha), what was indexed; and ``state``, one row
with the number of rows and words and the fingerprint of the corpus. Null and empty texts are rows without words; of
repeated keys the largest text holds; rows with a null key are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.search import K1, B, fingerprint
from tessera.operators.stems import index_terms
from tessera.session import ship_package

BUCKETS = 64
_QUERY_WORD = re.compile(r"[A-Za-z0-9_]+")


def _bucket(term: str):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _corpus(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(text).alias("text")).withColumn("sha", F.sha2("text", 256))


def build_index(docs: DataFrame, key: str, text: str, path: str) -> None:
    """Write the index of ``docs`` below ``path``, replacing an earlier one."""
    ship_package(docs.sparkSession)
    src = _corpus(docs, key, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"]):
                at: dict[str, list[int]] = {}
                words = index_terms(t)
                for i, w in enumerate(words):
                    at.setdefault(w, []).append(i)
                rows += [(k, len(words), w, p) for w, p in at.items()]
            yield pd.DataFrame(rows, columns=["key", "dl", "term", "positions"])

    schema = T.StructType([src.schema["key"], T.StructField("dl", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("positions", T.ArrayType(T.IntegerType()))])
    post = src.select("key", "text").mapInPandas(run, schema).withColumn("bucket", _bucket("term"))
    post.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(8))).sortWithinPartitions("term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    src.select("key", "sha").write.mode("overwrite").parquet(f"{path}/corpus")
    spark = docs.sparkSession
    stored = spark.read.parquet(f"{path}/corpus")
    words = spark.read.schema(post.schema).parquet(f"{path}/postings").agg(F.coalesce(F.sum(F.size("positions")), F.lit(0)).alias("n_words"))
    state = stored.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(words).crossJoin(_print(stored))
    state.write.mode("overwrite").parquet(f"{path}/state")


def _print(corpus: DataFrame) -> DataFrame:
    one = fingerprint(corpus.withColumn("all", F.lit(1)), "key", "sha", ["all"])
    return one.agg(F.max("fingerprint").alias("fingerprint"))


def index_state(spark: SparkSession, path: str, docs: DataFrame, key: str, text: str) -> str:
    """``missing``, ``stale`` (rows or fingerprint differ from ``docs``) or ``verified``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/state")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return "missing"
    had = spark.read.parquet(f"{path}/state").first()
    now = _corpus(docs, key, text)
    n, mark = now.count(), _print(now).first().fingerprint
    return "verified" if (had.n_rows, had.fingerprint) == (n, mark) else "stale"


def ensure_index(docs: DataFrame, key: str, text: str, path: str, *, force: bool = False) -> str:
    """Build the index unless it is there and fresh; what was found before: missing, stale, verified or forced."""
    state = "forced" if force else index_state(docs.sparkSession, path, docs, key, text)
    if state != "verified":
        build_index(docs, key, text, path)
    return state


def phrases(query: str) -> list[list[str]]:
    """A query's words, each as the stems of its parts, which must stand side by side; words without any are dropped."""
    return [p for w in _QUERY_WORD.findall(query) if (p := index_terms(w))]


def search(spark: SparkSession, path: str, queries: dict[str, str], key: str = "key", k: int = 8) -> DataFrame:
    """``(query_id, place, key, score)``: the k best rows of each query, lowest score first, ties by key."""
    terms = [(q, n, len(p), at, t) for q, text in sorted(queries.items()) for n, p in enumerate(phrases(text)) for at, t in enumerate(p)]
    wanted = spark.createDataFrame(terms, "query_id string, phrase int, m int, at int, term string")
    names = sorted({t[4] for t in terms})
    buckets = [r.b for r in spark.createDataFrame([(n,) for n in names], "term string").select(_bucket("term").alias("b")).distinct().collect()]
    key_type = spark.read.parquet(f"{path}/corpus").schema["key"].dataType.simpleString()
    post = spark.read.schema(f"key {key_type}, dl int, term string, positions array<int>, bucket int").parquet(f"{path}/postings").filter(F.col("bucket").isin(*buckets) & F.col("term").isin(*names))
    hit = post.join(F.broadcast(wanted), "term").select("query_id", "phrase", "m", "key", "dl", "at", F.explode("positions").alias("pos"))
    tf = hit.groupBy("query_id", "phrase", "m", "key", "dl", (F.col("pos") - F.col("at")).alias("start")).agg(F.countDistinct("at").alias("got")).filter("got = m").groupBy("query_id", "phrase", "key", "dl").agg(F.count(F.lit(1)).alias("f"))
    df = tf.groupBy("query_id", "phrase").agg(F.count(F.lit(1)).alias("df"))
    stats = spark.read.parquet(f"{path}/state").select("n_rows", "n_words")
    x = tf.join(F.broadcast(df), ["query_id", "phrase"]).crossJoin(F.broadcast(stats))
    raw = F.log((F.col("n_rows") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(raw > 0, raw).otherwise(1e-6)
    part = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / (F.col("n_words") / F.col("n_rows"))))
    scored = x.groupBy("query_id", "key").agg(F.round(-F.sum(part), 6).alias("score"))
    top = scored.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "key"))).filter(F.col("place") <= k)
    return top.select("query_id", F.col("place").cast("long").alias("place"), F.col("key").alias(key), "score")
