"""Registry of the SQL twins."""

from __future__ import annotations

from oracle.ctes import build

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = build(sql.strip())
