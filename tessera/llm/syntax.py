"""Source files that do not parse.

The language of a file is the one its path's extension stands for. Its text is lexed and the whole token stream
is run through the tables of the language's bundled grammar; the first token that cannot be fitted is the error.

Defined results: null texts are not checked; an empty text is valid Python, JavaScript, TypeScript, Java, YAML and
TOML, and invalid JSON and Go; files of other extensions give no row; repeated rows of a file count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import syntax_braces, syntax_data, syntax_python

#: Extension -> language.
LANGUAGES = {
    "py": "python",
    "js": "javascript",
    "ts": "typescript",
    "go": "go",
    "java": "java",
    "json": "json",
    "yaml": "yaml",
    "yml": "yaml",
    "toml": "toml",
}
CHECKERS: dict[str, Callable[[str], int | None]] = {
    "python": syntax_python.check,
    "javascript": syntax_braces.check_js,
    "typescript": syntax_braces.check_ts,
    "go": syntax_braces.check_go,
    "java": syntax_braces.check_java,
    "json": syntax_data.check_json,
    "yaml": syntax_data.check_yaml,
    "toml": syntax_data.check_toml,
}


def syntax_language(path: Column) -> Column:
    """Language by the extension of a path, null for others."""
    ext = F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)
    names = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    return F.element_at(names, F.nullif(ext, F.lit("")))


def first_error(language: str, text: str) -> int | None:
    """Line of the first error, None if there is none."""
    return CHECKERS[language](text)


def check_files(files: DataFrame, texts: DataFrame, *, file_id: str = "file_id", path: str = "path", text: str = "text") -> DataFrame:
    """``(file_id, syntax_language, error_line)`` of each checkable file with a text; a valid file has a null line."""
    paths = files.select(files[file_id].alias("file_id"), syntax_language(files[path]).alias("syntax_language")).filter("syntax_language IS NOT NULL AND file_id IS NOT NULL").distinct()
    src = texts.select(texts[file_id].alias("file_id"), texts[text].alias("text")).filter("text IS NOT NULL")
    both = src.join(paths, "file_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lines = [first_error(lang, t) for lang, t in zip(pdf["syntax_language"], pdf["text"])]
            yield pd.DataFrame({"file_id": pdf["file_id"], "syntax_language": pdf["syntax_language"], "error_line": pd.array(lines, dtype="Int32")})

    schema = T.StructType([both.schema["file_id"], T.StructField("syntax_language", T.StringType()), T.StructField("error_line", T.IntegerType())])
    return both.mapInPandas(run, schema)


def error_rates(checked: DataFrame, files: DataFrame, *, file_id: str = "file_id", repo: str = "repo") -> DataFrame:
    """``(repo, syntax_language, n_files, n_invalid, rate)`` over distinct files."""
    of = files.select(files[file_id].alias("file_id"), files[repo].alias("repo")).distinct()
    one = checked.groupBy("file_id", "syntax_language").agg(F.max(F.col("error_line").isNotNull().cast("int")).alias("bad"))
    n, bad = F.count(F.lit(1)), F.sum("bad")
    return one.join(of, "file_id").groupBy("repo", "syntax_language").agg(n.alias("n_files"), bad.alias("n_invalid"), (bad / n).alias("rate"))
