"""Imports and calls of parsed Python files, resolved to files and definitions of their repository."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import module_dotted


def qualified(symbol_id: str) -> Column:
    """``A.m`` of a symbol id ``module/A#m().``."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(symbol_id, "^[^/]*/", ""), r"\(\)\.|#", "."), r"\.$", "")


def import_targets(files: DataFrame, parsed: DataFrame) -> DataFrame:
    """``(file_id, repo, path, start_line, name, alias, root, target)`` of each imported name of ``parsed`` (with repo and path).

    J6: a submodule is preferred to its package, a full name to its top package; relative levels count from the file's
    folder. Modules may be named with the repository in front. ``target`` is null and ``root`` the package for names from
    outside; unresolved relative imports have neither.
    """
    py = files.filter(F.col("path").rlike(r"\.py[ix]?$"))
    modules = py.select("repo", module_dotted(F.col("path")).alias("module"), F.struct((~F.col("path").endswith(".py")).alias("stub"), "path").alias("p")).groupBy("repo", "module").agg(F.min("p").getField("path").alias("target")).filter("module <> ''")
    i = parsed.filter("kind = 'import'").select("file_id", "repo", "path", "start_line", F.col("name").alias("raw"), F.col("detail").alias("asname"))
    is_from = F.col("raw").contains(":")
    source = F.substring_index("raw", ":", 1)
    level = F.length(F.regexp_extract(source, r"^\.*", 0))
    rest = F.regexp_replace(source, r"^\.+", "")
    parts = F.split(F.regexp_replace(F.regexp_replace("path", r"^src/", ""), r"\.py[ix]?$", ""), "/")
    folder = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - level, F.lit(0))), ".")
    name = F.when(is_from, F.substring_index("raw", ":", -1)).otherwise(F.col("raw"))
    base = F.when(level > 0, F.concat_ws(".", F.nullif(folder, F.lit("")), F.nullif(rest, F.lit("")))).otherwise(rest)
    i = i.withColumns({"name": name, "base": base, "level": level, "plain": ~is_from})
    top = F.substring_index("name", ".", 1)
    own = lambda c: F.when(F.substring_index(c, ".", 1) == F.col("repo"), F.substring(c, F.length("repo") + 2, F.length(c)))
    sub = F.concat_ws(".", F.nullif(F.col("base"), F.lit("")), F.col("name"))
    wanted = F.when(F.col("plain"), F.array(F.col("name"), own(F.col("name")), top)).otherwise(F.array(sub, own(sub), F.col("base"), own(F.col("base"))))
    alias = F.coalesce("asname", F.when(F.col("plain"), top).otherwise(F.col("name")))
    root = F.when(F.col("level") > 0, "").otherwise(F.substring_index(F.when(F.col("plain"), F.col("name")).otherwise(F.col("base")), ".", 1))
    i = i.withColumns({"alias": alias, "root": root})
    key = ["file_id", "repo", "path", "start_line", "name", "alias", "root"]
    tries = i.select(*key, F.posexplode(wanted).alias("place", "module"))
    hit = tries.join(modules, ["repo", "module"], "left")
    return hit.groupBy(*key).agg(F.min(F.when(F.col("target").isNotNull(), F.struct("place", "target"))).getField("target").alias("target"))


def unique_names(defs: DataFrame) -> DataFrame:
    """``(repo, name, target_id)`` of names that stand for one definition of their repository."""
    return defs.groupBy("repo", "name").agg(F.countDistinct("target_id").alias("n"), F.min("target_id").alias("target_id")).filter("n = 1").drop("n")


def resolve_calls(calls: DataFrame, imports: DataFrame, defs: DataFrame) -> DataFrame:
    """``calls`` (repo, path, name) with target_id and confidence.

    J7: a top-level definition of the same file (medium), for bare names an imported one (medium), a name that is unique in
    the repository (low), else unresolved. ``defs`` holds (repo, path, name, target_id, top).
    """
    top = defs.filter("top").groupBy("repo", "path", "name").agg(F.max("target_id").alias("target_id"))
    near = top.select("repo", "path", F.col("name").alias("callee"), F.col("target_id").alias("near"))
    there = top.select("repo", F.col("path").alias("target"), "name", "target_id")
    alias = imports.filter("target IS NOT NULL").join(there, ["repo", "target", "name"]).groupBy("repo", "path", F.col("alias").alias("name")).agg(F.max("target_id").alias("imported"))
    far = unique_names(defs).select("repo", F.col("name").alias("callee"), F.col("target_id").alias("far"))
    x = calls.withColumn("callee", F.substring_index("name", ".", -1)).join(near, ["repo", "path", "callee"], "left").join(alias, ["repo", "path", "name"], "left").join(far, ["repo", "callee"], "left")
    confidence = F.when(F.coalesce("near", "imported").isNotNull(), "medium").when(F.col("far").isNotNull(), "low").otherwise("unresolved")
    return x.withColumns({"target_id": F.coalesce("near", "imported", "far"), "confidence": confidence}).drop("near", "imported", "far")
