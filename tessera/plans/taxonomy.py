"""Dimension tables of topic families, their detectors and the profiles of pages."""

from __future__ import annotations

# Thirteen families as key -> (label, coverage labels, keywords).
FAMILIES = {
    "frontend": ("Frontend / i18n / UI architecture", ("ui", "i18n", "web-frontend"), ("frontend", "front-end", "i18n", "internationalization", "theming", "ui component", "web ui", "umi", "tailwind")),
    "memory": ("Memory system", ("memory-system",), ("memory", "episodic", "procedural memory", "semantic memory")),
    "queue-system": ("Task queues and Redis Streams", ("queue", "task-queue", "redis-streams"), ("queue", "redis stream", "redis streams", "task executor", "task worker", "task lifecycle")),
    "helm-k8s": ("Kubernetes and Helm deployment", ("kubernetes", "helm", "k8s"), ("kubernetes", "k8s", "helm", "helm chart", "ingress", "values.yaml")),
    "ci-cd-build": ("CI/CD and build system", ("ci-cd", "cicd", "build-system"), ("ci/cd", "cicd", "continuous integration", "github actions", "github workflow", "build system", "docker build", "release script")),
    "go-native": ("Go server and native components", ("golang", "native-components"), ("golang", "go server", "go service", "native component", "go module", "go binary")),
    "retrieval-internals": ("Retrieval and search internals", ("search-internals",), ("document store", "docstore", "hybrid search", "reranking", "rerank", "query transformation", "query processing", "response generation", "citation insertion", "index selection")),
    "doc-processing": ("Document parsing, OCR, layout, and chunking", ("document-parsing", "ocr", "chunking"), ("deepdoc", "mineru", "ocr", "layout recognition", "layout analysis", "parser factory", "chunking strategy", "document parsing", "content enhancement")),
    "llm-internals": ("LLM provider internals, tool calling, retry, usage", ("llm-provider",), ("llmbundle", "tool calling", "function calling", "retry logic", "backoff", "usage tracking", "model registration", "provider implementation")),
    "user-tenant-admin-health": ("User, tenant, admin, and system health", ("admin", "tenant", "health"), ("tenant", "admin service", "admin route", "health endpoint", "health check", "system health", "user management", "status probe")),
    "sandbox-executor": ("Sandbox / code executor", ("sandbox", "code-executor"), ("sandbox", "code executor", "code execution", "executor manager")),
    "migrations-operations": ("Migrations and operations", ("migrations", "operations"), ("migration", "schema sync", "oceanbase", "upgrade path", "runbook", "reset command", "database migration", "utility script")),
    "glossary": ("Glossary", (), ("glossary", "terminology", "acronym")),
}

# What signals a family: endings, folders, whole names, words in names, path beginnings, packs, words in symbols.
DETECTORS = {
    "frontend": {
        "ext": (".tsx", ".jsx", ".vue", ".svelte", ".scss", ".less"), "dir": ("web", "frontend", "ui", "i18n", "locales", "locale"),
        "file": ("package.json", "tsconfig.json", ".umirc.ts", "tailwind.config.js", "tailwind.config.ts", "vite.config.ts"), "name": ("tailwind", "umirc", "vite", "webpack", "i18n"),
    },
    "memory": {"dir": ("memory",), "name": ("memory",), "symbol": ("memory",)},
    "queue-system": {"dir": ("queue", "queues", "workers", "svr"), "name": ("queue", "worker", "celery", "dramatiq", "huey", "consumer", "broker", "scheduler"), "pack": ("task_workers",), "symbol": ("celery", "taskqueue")},
    "helm-k8s": {"dir": ("helm", "charts", "chart", "kubernetes", "k8s", "kube"), "file": ("chart.yaml", "values.yaml"), "name": ("values", "ingress", "deployment", "statefulset", "configmap")},
    "ci-cd-build": {
        "dir": (".github", "workflows"), "file": ("dockerfile", "makefile", "docker-compose.yml", "docker-compose.yaml", "jenkinsfile", ".dockerignore"),
        "name": ("dockerfile", "docker-compose", "makefile"), "path": (".github/",),
    },
    "go-native": {"ext": (".go",), "dir": ("cmd", "golang"), "file": ("go.mod",)},
    "retrieval-internals": {"name": ("rerank", "ranker", "retriever", "retrieval", "hybrid", "recall", "dealer", "docstore"), "symbol": ("rerank", "retriever", "hybrid", "dealer", "docstore")},
    "doc-processing": {"dir": ("deepdoc", "mineru", "parsers"), "name": ("parser", "chunk", "chunker", "ocr", "layout", "deepdoc", "mineru", "embedding"), "symbol": ("parser", "chunk", "ocr", "layout")},
    "llm-internals": {"dir": ("llm",), "name": ("llmbundle", "chat_model", "embedding_model", "rerank_model", "cv_model", "provider"), "pack": ("llm_integrations",), "symbol": ("llmbundle",)},
    "user-tenant-admin-health": {"dir": ("admin",), "name": ("tenant", "admin", "health", "probe", "user_service", "user_app"), "symbol": ("tenant", "admin")},
    "sandbox-executor": {"dir": ("sandbox",), "name": ("sandbox",), "symbol": ("sandbox",)},
    "migrations-operations": {"dir": ("migration", "migrations", "alembic"), "name": ("migration", "migrate", "alembic", "oceanbase", "upgrade", "schema_sync"), "symbol": ("migration", "migrate")},
    "glossary": {},
}

# A family's suggested profile where it is not the deep dive, and what status says of strength, priority and evidence.
DEFAULT_PROFILE = "subsystem-deep-dive"
SUGGESTED_PROFILE = {"helm-k8s": "deployment-runbook", "ci-cd-build": "deployment-runbook", "user-tenant-admin-health": "operations-page", "migrations-operations": "operations-page", "glossary": "glossary"}
STATUS = {"present": ("high", "must", 3), "low": ("low", "should", 2), "missing": ("none", "could", 0), "synthesized": ("medium", "should", 0)}

# Ten profiles as key -> (required blocks, those that need no evidence, floor lanes, least exact items).
PROFILES = {
    "overview": (("purpose", "architecture", "key_files"), ("purpose",), ("file_anchor", "symbol_anchor", "query_pack"), 1),
    "architecture-flow": (("purpose", "flow", "key_files"), ("purpose",), ("file_anchor", "symbol_anchor"), 2),
    "subsystem-deep-dive": (("purpose", "entrypoints", "flow", "key_files", "tests"), ("purpose",), ("file_anchor", "symbol_anchor", "test"), 3),
    "api-reference": (("purpose", "route_matrix", "request_response", "handlers", "examples_tests", "known_gaps"), ("purpose", "known_gaps"), ("contract", "file_anchor", "symbol_anchor"), 2),
    "configuration-reference": (("config_matrix", "defaults_source", "consumers", "operational_notes"), ("operational_notes",), ("file_anchor", "query_pack", "symbol_anchor"), 2),
    "deployment-runbook": (("entrypoints", "containers", "orchestration", "config_secrets", "health_ops", "rollback"), ("rollback",), ("file_anchor", "query_pack"), 2),
    "developer-workflow": (("purpose", "entrypoints", "flow", "tests"), ("purpose",), ("file_anchor", "test", "symbol_anchor"), 2),
    "data-model-reference": (("purpose", "data_models", "key_files"), ("purpose",), ("symbol_anchor", "file_anchor"), 2),
    "operations-page": (("purpose", "operations", "key_files", "known_gaps"), ("purpose", "known_gaps"), ("file_anchor", "query_pack"), 1),
    "glossary": (("term", "source_occurrence", "meaning_context"), ("term", "source_occurrence", "meaning_context"), (), 0),
}

assert set(DETECTORS) == set(FAMILIES) and len({label for label, _, _ in FAMILIES.values()}) == len(FAMILIES)
