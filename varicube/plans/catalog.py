"""All registered queries and their SQL."""

from __future__ import annotations

from varicube.plans import denoising, registry, tables_and_tuning, taxa_and_reads  # noqa: F401  (importing registers)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
