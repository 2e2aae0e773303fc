"""Build oracle statements: shared table definitions as CTEs, and a cast of each result column.

An oracle entry is ``(columns, select)``. ``columns`` lists ``name:kind`` in result order, kind being i (bigint),
f (double to four digits), d (date) or t (text).
"""

from __future__ import annotations

import re

from oracle.tables import TABLES

_CASTS = {
    "i": "CAST({0} AS BIGINT)",
    "f": "CAST(ROUND(CAST({0} AS DECIMAL(38,8)), 4) AS DOUBLE)",
    "d": "CAST({0} AS DATE)",
    "t": "CAST({0} AS VARCHAR)",
}


def used_tables(text: str) -> list[str]:
    """Shared tables a statement needs, each after those it reads."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in TABLES:
            if name not in ordered and re.search(rf"\b{name}\b", sql):
                visit(TABLES[name])
                ordered.append(name)

    visit(text)
    return ordered


def statement(columns: str, select: str) -> str:
    tables = ",\n".join(f"{name} AS (\n{TABLES[name].strip()}\n)" for name in used_tables(select))
    casts = []
    for item in columns.split():
        name, kind = item.split(":")
        casts.append(f"{_CASTS[kind].format(name)} AS {name}")
    prefix = f"WITH {tables},\n" if tables else "WITH "
    return f"{prefix}result AS (\n{select.strip()}\n)\nSELECT {', '.join(casts)} FROM result"
