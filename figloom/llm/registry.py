"""All queries of this subpackage, with their SQL where there is one."""

from __future__ import annotations

from figloom.llm import forest, oracle, overlap, queries_items, queries_text


def queries() -> dict:
    return forest.QUERIES | overlap.QUERIES | queries_text.QUERIES | queries_items.QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
