"""Pattern packs over the lines of texts: first match, all matches, capped digests with uncapped totals, previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import capped

# Named packs as (pattern, file endings, purpose).
PACKS = {
    "web_routes": (r"@\w+\.(?:route|get|post|put|delete|patch|websocket)\(|add_url_rule\(|@(?:app|router|bp|blueprint|api)\.\w+\(|path\(|re_path\(|url\(|APIRouter\(|Blueprint\(", ".py", "HTTP and WebSocket routes"),
    "task_workers": (r"@(?:app|celery|shared_task|huey|dramatiq)\.?\w*\.?task\b|@shared_task|@task\(|@celery_app\.task|@dramatiq\.actor|\.delay\(|\.apply_async\(|Queue\(|RQ\b|rq\.", ".py", "background tasks and job queues"),
    "cli_commands": (r"@(?:click|app|cli|group)\.(?:command|group)\(|@command\(|argparse\.ArgumentParser|add_argument\(|add_parser\(|typer\.Typer\(|@app\.callback\(|click\.Group", ".py", "command line definitions"),
    "models_schemas": (
        r"class\s+\w+\((?:[^)]*\b(?:Base|Model|BaseModel|Schema|models\.Model|declarative_base|TypedDict|Document)\b[^)]*)\)|\b(?:Column|relationship|mapped_column|Mapped\[|Field\(|CharField|TextField|ForeignKey|@dataclass)\b",
        ".py",
        "data models and schemas",
    ),
    "env_vars": (r"os\.environ|os\.getenv\(|getenv\(|environ\.get\(|BaseSettings|pydantic_settings|Settings\(", ".py", "environment variables"),
    "config_keys": (r"^[A-Z][A-Z0-9_]{2,}\s*[=:]|settings\.\w+|config\[|\.config\.|Config\b|conf\.|getattr\(settings", ".py", "settings keys in code"),
    "config_file_keys": (r"^\s*[A-Za-z_][A-Za-z0-9_.\-]*\s*[:=]|^\s*\[[^\]]+\]", ".toml .ini .cfg .env .yaml .yml", "keys and sections of configuration files"),
    "plugin_registries": (r"importlib|__import__|import_module|register\(|registry\b|REGISTRY|FACTORY|factory\b|entry_points|pkg_resources|plugin|get_plugin|load_module|globals\(\)\[", ".py", "plugins, registries and factories"),
    "datastore": (r"\b(?:psycopg2?|asyncpg|sqlalchemy|create_engine|sessionmaker|Session\(|redis|aioredis|pymongo|MongoClient|boto3|elasticsearch|Elasticsearch|sqlite3|cassandra|clickhouse|Cache\(|cache\.|MinIO|minio)\b", ".py", "databases, caches and stores"),
    "auth_security": (r"\b(?:login_required|current_user|api_key|APIKey|jwt|JWT|oauth|OAuth|Depends\(|HTTPBearer|authenticate|authorize|permission|hash_password|bcrypt|passlib|csrf|middleware|Middleware)\b", ".py", "authentication and security"),
    "entrypoints": (r"if\s+__name__\s*==\s*['\"]__main__['\"]|def\s+main\s*\(|app\.run\(|uvicorn\.run|hypercorn|gunicorn|asyncio\.run\(|run_until_complete", ".py", "process entry points"),
    "llm_integrations": (r"\b(?:openai|OpenAI|anthropic|Anthropic|claude|ollama|litellm|langchain|llama_index|cohere|Cohere|huggingface|transformers|google\.generativeai|genai|mistralai)\b", ".py", "model providers"),
}
# Folders that are never scanned.
SKIPPED = ("node_modules", ".venv", "venv", "dist", "build", ".git", "site-packages", "__pycache__", ".next", "target")
RAW_CAP, DIGEST_CAP = 4000, 80


def scannable(path: str):
    """No part of the path is a skipped folder."""
    return ~F.exists(F.split(F.col(path), "/"), lambda p: p.isin(*SKIPPED))


def scan(lines: DataFrame, keys: list[str], path: str, packs: tuple[str, ...] | None = None) -> DataFrame:
    """``keys``, pack, line_no, line, n_matches, first_match of each matching line; one pass over the lines for all packs, or those named."""
    tests = []
    for name, (pattern, ends, _) in PACKS.items():
        if packs is not None and name not in packs:
            continue
        fits = reduce(lambda a, b: a | b, [F.col(path).endswith(e) for e in ends.split()])
        tests.append(F.when(fits & F.col("line").rlike(pattern), F.struct(F.lit(name).alias("pack"), F.size(F.regexp_extract_all("line", F.lit(pattern), F.lit(0))).alias("n_matches"), F.regexp_extract("line", pattern, 0).alias("first_match"))))
    hits = lines.filter(scannable(path)).withColumn("hit", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())))
    return hits.select(*keys, "line_no", "line", "hit.*")


def digest(hits: DataFrame, order: list[str], cap: int = DIGEST_CAP) -> DataFrame:
    """First hits of each pack in order, with the uncapped total and a truncation flag."""
    return capped(hits, ["pack"], [F.col(c) for c in order], cap)


def preview(hits: DataFrame, lines: DataFrame, keys: list[str], around: int = 2) -> DataFrame:
    """Hits with the lines around them."""
    near = hits.select(*keys, "pack", "line_no", F.explode(F.sequence(F.col("line_no") - around, F.col("line_no") + around)).alias("at"))
    got = near.join(lines.select(*keys, F.col("line_no").alias("at"), F.col("line").alias("text")), [*keys, "at"])
    return got.groupBy(*keys, "pack", "line_no").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("c")).withColumn("context", F.array_join("c.text", "\n")).drop("c")


def preview_texts(texts: DataFrame, keys: list[str], path: str, text: str, around: int = 2) -> DataFrame:
    """What ``preview`` gives for all hits of ``scan``, from whole texts: no line is joined."""
    lines = F.split(text, "\n", -1)
    near = lambda i: F.array_join(F.slice("ls", F.greatest(i + 1 - around, F.lit(1)), F.least(i, F.lit(around)) + around + 1), "\n")
    matching = lambda pattern: F.filter(F.transform("ls", lambda x, i: F.when(x.rlike(pattern), i)), lambda i: i.isNotNull())
    packs = []
    for name, (pattern, ends, _) in PACKS.items():
        fits = reduce(lambda a, b: a | b, [F.col(path).endswith(e) for e in ends.split()])
        packs.append(F.when(fits, F.struct(F.lit(name).alias("pack"), matching(pattern).alias("at"))))
    src = texts.filter(scannable(path) & F.col(text).isNotNull()).withColumn("ls", lines)
    hits = F.filter(F.array(*packs), lambda x: x.isNotNull())
    rows = F.flatten(F.transform(hits, lambda h: F.transform(h["at"], lambda i: F.struct(h["pack"].alias("pack"), (i + 1).alias("line_no"), near(i).alias("context")))))
    return src.select(*keys, F.explode(rows).alias("hit")).select(*keys, "hit.*")
