"""SQL twins of the registered queries, written for DuckDB without any of Spark's plans."""

from __future__ import annotations


def oracle_texts() -> dict[str, str]:
    from oracle import gold, streams  # noqa: F401  (they register their texts)
    from oracle.texts import ORACLES

    return dict(ORACLES)
