"""All queries of the core library, with their SQL where there is one."""

from __future__ import annotations

from figloom import oracle, oracle_made, oracle_text, oracle_xml, p_general, queries as own, queries_made


def queries() -> dict:
    return own.QUERIES | queries_made.QUERIES | p_general.QUERIES


def oracle_sql() -> dict[str, str]:
    return oracle.SQL | oracle_xml.SQL | oracle_text.SQL | oracle_made.SQL
