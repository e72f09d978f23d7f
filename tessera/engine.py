"""One object for the composite queries; every method returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import chunking, graph, hierarchy, joins, patterns, ranking, search
from tessera.session import ship_package
from tessera.sources.repository import read_repository


class Engine:
    """Inventory, chunks, search, resolution, graph and evidence over tables or a repository on disk."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        ship_package(spark)

    def inventory(self, root: str, repo: str) -> DataFrame:
        return read_repository(self.spark, root, repo)

    def chunks(self, files: DataFrame, *, length: int = 160, overlap: int = 15) -> DataFrame:
        return chunking.line_windows(files, ["repo", "path"], "text", length=length, overlap=overlap)

    def scan(self, files: DataFrame) -> DataFrame:
        return patterns.scan(chunking.text_lines(files, ["repo", "path"], "text"), ["repo", "path"], "path")

    def search(self, docs: DataFrame, key: str, text: str, queries: list[str], k: int = 8) -> DataFrame:
        q = self.spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
        return search.bm25(docs, key, F.col(text), q, k)

    def similar(self, base: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 8) -> DataFrame:
        return search.cosine_top_k(base, queries, key, vector, k)

    def resolve(self, refs: DataFrame, ref_keys: list[str], aliases: DataFrame, alias_keys: list[str], handle: str) -> DataFrame:
        return joins.resolve(refs, ref_keys, aliases, alias_keys, handle)

    def neighbours(self, edges: DataFrame, seeds: DataFrame, cap: int = 8) -> DataFrame:
        return graph.neighbours(edges, seeds, cap)

    def retrieve(self, hits: DataFrame) -> DataFrame:
        return ranking.fold_hits(hits)

    def hierarchy(self, links: DataFrame) -> DataFrame:
        return hierarchy.resolve_hierarchy(links)
