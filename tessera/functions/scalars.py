"""Column expressions on paths, texts and ids. All of them stay inside the JVM; none needs a Python worker."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extension -> language.
EXTENSIONS = {
    ".py": "python",
    ".pyi": "python",
    ".pyx": "python",
    ".go": "go",
    ".ts": "typescript",
    ".tsx": "tsx",
    ".js": "javascript",
    ".mjs": "javascript",
    ".cjs": "javascript",
    ".jsx": "jsx",
    ".c": "c",
    ".h": "c",
    ".cc": "cpp",
    ".cpp": "cpp",
    ".cxx": "cpp",
    ".hpp": "cpp",
    ".hh": "cpp",
    ".java": "java",
    ".rs": "rust",
    ".rb": "ruby",
    ".php": "php",
    ".sh": "shell",
    ".bash": "shell",
    ".zsh": "shell",
    ".sql": "sql",
    ".md": "markdown",
    ".mdx": "markdown",
    ".rst": "rst",
    ".txt": "text",
    ".toml": "toml",
    ".ini": "ini",
    ".cfg": "ini",
    ".yaml": "yaml",
    ".yml": "yaml",
    ".json": "json",
    ".json5": "json",
    ".env": "dotenv",
    ".tmpl": "template",
    ".tpl": "template",
    ".j2": "jinja",
    ".html": "html",
    ".htm": "html",
    ".css": "css",
    ".less": "less",
    ".scss": "scss",
    ".vue": "vue",
    ".svelte": "svelte",
    ".dockerfile": "dockerfile",
    ".proto": "protobuf",
}
# Extensions of files that are listed but never read.
BINARY = (
    ".png",
    ".jpg",
    ".jpeg",
    ".gif",
    ".svg",
    ".ico",
    ".webp",
    ".bmp",
    ".pdf",
    ".woff",
    ".woff2",
    ".ttf",
    ".otf",
    ".eot",
    ".zip",
    ".gz",
    ".tar",
    ".whl",
    ".so",
    ".dylib",
    ".dll",
    ".bin",
    ".mp4",
    ".mp3",
    ".wav",
    ".pyc",
    ".o",
    ".a",
    ".class",
    ".jar",
    ".parquet",
    ".npy",
    ".pkl",
    ".pem",
    ".faiss",
    ".sqlite",
)
# Marks of the category cascade.
VENDOR_PARTS = ("web/dist/", "web/node_modules/", "/dist/", "/.next/", "/vendor/", "/third_party/", "/thirdparty/", "/external/", "/site-packages/")
GENERATED_NAMES = ("uv.lock", "go.sum", "package-lock.json", "yarn.lock", "pnpm-lock.yaml", "poetry.lock", "Cargo.lock", "composer.lock")
GENERATED_ENDS = (".min.js", ".min.css", ".pb.go", "_pb2.py", "_pb2_grpc.py", ".lock")
CONFIG_NAMES = ("pyproject.toml", "setup.cfg", "setup.py", "go.mod", "codecov.yml", ".pre-commit-config.yaml", "pytest.ini", "tox.ini", "mypy.ini")
TEXT_CAP = 1_500_000


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Last dotted suffix of the file name in lower case, empty if it has none."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.](\.[^.]+)$", 1))


def top_dir(path: Column) -> Column:
    """First folder of a path, ``(root)`` for files at the top."""
    return F.when(path.contains("/"), F.substring_index(path, "/", 1)).otherwise(F.lit("(root)"))


def language_for(ext: Column, name: Column) -> Column:
    """Names win over extensions; everything unknown is ``other``."""
    low = F.lower(name)
    table = F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv))
    return (
        F.when(low.startswith("dockerfile"), "dockerfile")
        .when(low.isin("go.mod", "go.sum"), "go-mod")
        .when(low == "makefile", "makefile")
        .otherwise(F.coalesce(F.element_at(table, ext), F.lit("other")))
    )


def is_generated(path: Column) -> Column:
    return base_name(path).isin(*GENERATED_NAMES) | any_of([base_name(path).endswith(e) for e in GENERATED_ENDS]) | F.concat(F.lit("/"), F.lower(path)).contains("/migrations/versions/")


def is_vendor(path: Column) -> Column:
    rooted = F.concat(F.lit("/"), path)
    return any_of([rooted.contains(p) for p in VENDOR_PARTS])


def classify(path: Column) -> Column:
    """Category by the first rule that fits: asset, generated, vendor, deployment, test, docs, config, source, other."""
    name, ext, low = base_name(path), extension(path), F.lower(path)
    lname, rooted = F.lower(name), F.concat(F.lit("/"), F.lower(path))
    deployment = (
        lname.contains("dockerfile")
        | lname.contains("docker-compose")
        | low.startswith("docker/")
        | low.startswith("helm/")
        | rooted.contains("/.github/workflows/")
        | (low.endswith(".tmpl") & low.contains("helm"))
        | lname.isin("build.sh", "entrypoint.sh")
        | low.startswith("deploy/")
        | rooted.contains("/k8s/")
    )
    test = (
        rooted.contains("/test/")
        | rooted.contains("/tests/")
        | rooted.contains("/__tests__/")
        | lname.startswith("test_")
        | (lname == "conftest.py")
        | any_of([low.endswith(e) for e in ("_test.go", "_test.py", ".test.ts", ".test.tsx", ".spec.ts")])
    )
    config = ext.isin(".toml", ".cfg", ".ini", ".env", ".yaml", ".yml", ".json") | ((ext == "") & name.startswith(".env")) | name.isin(*CONFIG_NAMES) | low.startswith("conf/")
    code = [e for e, lang in EXTENSIONS.items() if lang not in ("markdown", "text", "rst")]
    return (
        F.when(ext.isin(*BINARY), "asset")
        .when(is_generated(path), "generated")
        .when(is_vendor(path), "vendor")
        .when(deployment, "deployment")
        .when(test, "test")
        .when(ext.isin(".md", ".mdx", ".rst") | low.startswith("docs/"), "docs")
        .when(config, "config")
        .when(ext.isin(*code), "source")
        .otherwise("other")
    )


def indexable(path: Column, size: Column) -> Column:
    """Neither binary, generated nor vendored, of a text extension and below the size cap."""
    return ~extension(path).isin(*BINARY) & ~is_generated(path) & ~is_vendor(path) & extension(path).isin(*EXTENSIONS) & (size <= TEXT_CAP)


def line_count(text: Column) -> Column:
    """Newlines, one more unless the text ends with one; 0 for empty and null texts."""
    n = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(F.coalesce(text, F.lit("")) == "", 0).when(text.endswith("\n"), n).otherwise(n + 1).cast("long")


def token_estimate(text: Column) -> Column:
    return F.floor((F.length(F.coalesce(text, F.lit(""))) + 3) / 4).cast("long")


def module_dotted(path: Column) -> Column:
    """Dotted module of a Python path: one leading ``src/`` and the suffix go, ``__init__`` stands for its folder."""
    p = F.regexp_replace(F.regexp_replace(path, r"^src/", ""), r"\.(?:py|pyi|pyx)$", "")
    return F.regexp_replace(F.replace(p, F.lit("/"), F.lit(".")), r"(?:^|\.)__init__$", "")


def clip(text: Column, limit: int, mark: str = "\n…[truncated]") -> Column:
    """Texts above ``limit`` characters cut there, trailing white space removed, with a mark after it."""
    return F.when(F.length(text) > limit, F.concat(F.regexp_replace(F.substring(text, 1, limit), r"\s+$", ""), F.lit(mark))).otherwise(F.coalesce(text, F.lit("")))


def slug(text: Column, limit: int = 64) -> Column:
    """Letters and digits in lower case, blanks and ``-_/.`` as single dashes, everything else dropped."""
    s = F.regexp_replace(F.lower(F.trim(text)), r"[ \-_/.]", "-")
    s = F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}\-]", ""), "-{2,}", "-")
    s = F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, limit)
    return F.when(s == "", "item").otherwise(s)


def kebab(text: Column, joiner: str = "-") -> Column:
    """Runs of anything but ``0-9a-z`` become one joiner, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^0-9a-z]+", joiner), f"^{joiner}|{joiner}$", "")


def bounded(text: Column, phrase: str) -> Column:
    """Whether a phrase occurs with no letter or digit right beside it, case-insensitively."""
    return F.lower(text).rlike(r"(?<![a-z0-9])\Q" + phrase.lower() + r"\E(?![a-z0-9])")


def anchor_start(ref: Column) -> Column:
    """First line of ``path:N`` or ``path:N-M``; reversed ranges are swapped; null without an anchor."""
    a, b = _anchor(ref)
    return F.least(a, b)


def anchor_end(ref: Column) -> Column:
    a, b = _anchor(ref)
    return F.greatest(a, b)


def _anchor(ref: Column) -> tuple[Column, Column]:
    pat = r":(\d+)(?:-(\d+))?$"
    a = F.nullif(F.regexp_extract(ref, pat, 1), F.lit("")).cast("int")
    b = F.nullif(F.regexp_extract(ref, pat, 2), F.lit("")).cast("int")
    return a, F.coalesce(b, a)


def signal_status(files: Column, hits: Column, symbols: Column) -> Column:
    """missing when all counts are 0, present from 3 files, 5 hits or 3 symbols on, else low."""
    return F.when((files == 0) & (hits == 0) & (symbols == 0), "missing").when((files >= 3) | (hits >= 5) | (symbols >= 3), "present").otherwise("low")
