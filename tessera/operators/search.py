"""Lexical and vector search: an inverted index with BM25 scores, exact cosine top-k, fingerprints and freshness."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

K1, B = 1.2, 0.75


def fingerprint(df: DataFrame, key: str, sha: str, part: list[str]) -> DataFrame:
    """Order-independent digest of the distinct (key, sha) pairs per group; a null sha counts as empty.

    The digest is taken over two sums of hashed pairs and their number, so partial sums are formed before the shuffle
    and no group is ever gathered.
    """
    pair = F.concat(F.col(key), F.lit("\t"), F.coalesce(F.col(sha), F.lit("")), F.lit("\n"))
    one = df.select(*part, F.md5(pair).alias("h")).distinct()
    sums = [F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(20,0)")).cast("string") for at in (1, 16)]
    return one.groupBy(*part).agg(F.sha2(F.concat_ws(":", *sums, F.count(F.lit(1)).cast("string")), 256).alias("fingerprint"))


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """``(key, pos, term)`` of every word; words are runs of a-z and 0-9 in lower case."""
    return docs.select(key, F.posexplode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))).alias("pos", "term"))


def bm25(docs: DataFrame, key: str, text: Column, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, place, key, score)``: the k lowest scores of each query.

    ``queries`` is (query_id, query). Each word of a query is one phrase of its parts (``list_items`` must match as two
    adjacent words); repeated words count again. Scores are negative sums of idf-weighted term frequencies.
    """
    words = queries.select("query_id", F.posexplode(F.regexp_extract_all(F.lower("query"), F.lit("[a-z0-9_]+"), F.lit(0))).alias("phrase", "word"))
    parts = words.select("query_id", "phrase", F.array_remove(F.split("word", "_"), "").alias("parts")).filter(F.size("parts") > 0)
    terms = parts.select("query_id", "phrase", F.size("parts").alias("m"), F.posexplode("parts").alias("at", "term"))
    # one array a row, evaluated once, serves lengths, totals and words
    arrays = docs.select(key, F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)).alias("words"))
    stats = arrays.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.when(F.col("words").isNotNull(), F.size("words"))).alias("total"))
    toks = arrays.select(key, F.size("words").alias("dl"), F.posexplode("words").alias("pos", "term"))
    hit = toks.join(F.broadcast(terms), "term").groupBy("query_id", "phrase", "m", key, "dl", (F.col("pos") - F.col("at")).alias("start")).agg(F.countDistinct("at").alias("got"))
    tf = hit.filter("got = m").groupBy("query_id", "phrase", key, "dl").agg(F.count(F.lit(1)).alias("f"))
    df = tf.groupBy("query_id", "phrase").agg(F.count(F.lit(1)).alias("df"))
    x = tf.join(F.broadcast(df), ["query_id", "phrase"]).crossJoin(F.broadcast(stats))
    raw = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(raw > 0, raw).otherwise(1e-6)
    part = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / (F.col("total") / F.col("n_docs"))))
    scored = x.groupBy("query_id", key).agg(F.round(-F.sum(part), 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy("score", key)
    return scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("query_id", F.col("place").cast("long").alias("place"), key, "score")


QUERY_BLOCK, BASE_BLOCK, _STRIPE = 2048, 32768, 4096


def cosine_top_k(base: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``(query, place, key, score)``: the k rows of ``base`` nearest to each query row, itself excluded.

    All rows are scored exactly. Both sides are cut into blocks of bounded size by a hash of the key; each pair of blocks
    is one group, whose matrices are multiplied and of which the best k of each query stay, and these are merged.
    Null vectors, vectors of length 0 and null keys are in no result.
    """
    key_type = base.schema[key].dataType
    usable = F.col(vector).isNotNull() & F.col(key).isNotNull()
    q, b = queries.filter(usable).select(F.col(key).alias("key"), F.col(vector).alias("v")), base.filter(usable).select(F.col(key).alias("key"), F.col(vector).alias("v"))
    n_q, n_b = (max(1, -(-df.count() // size)) for df, size in ((q, QUERY_BLOCK), (b, BASE_BLOCK)))
    block = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumns({"qb": block(n_q)}).withColumn("bb", every(n_b))
    b = b.withColumns({"bb": block(n_b)}).withColumn("qb", every(n_q))

    def unit(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        pdf = pdf.drop_duplicates("key") if len(pdf) and not isinstance(pdf["v"].iloc[0], float) else pdf
        m = np.array([np.asarray(x, dtype=np.float64) for x in pdf["v"]]).reshape(len(pdf), -1)
        norm = np.sqrt((m * m).sum(axis=1))
        keep = norm > 0
        return pdf[keep], m[keep] / norm[keep, None]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            (left, a), (right, c) = unit(left), unit(right.sort_values("key", kind="stable"))
            names, own = right["key"].to_numpy(), left["key"].to_numpy()
            for at in range(0, len(right), _STRIPE):
                s = np.round(a @ c[at : at + _STRIPE].T, 6)
                s[own[:, None] == names[None, at : at + _STRIPE]] = -np.inf
                # keys ascend in a stripe, so a stable sort breaks ties by key
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                out += [(o, names[at + j], s[i, j]) for i, o in enumerate(own) for j in best[i] if s[i, j] > -np.inf]
        return pd.DataFrame(out, columns=["query", "key", "score"])

    schema = T.StructType([T.StructField("query", key_type), T.StructField("key", key_type), T.StructField("score", T.DoubleType())])
    near = q.groupBy("qb", "bb").cogroup(b.groupBy("qb", "bb")).applyInPandas(score, schema)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return near.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("query", F.col("place").cast("long").alias("place"), F.col("key").alias(key), "score")
