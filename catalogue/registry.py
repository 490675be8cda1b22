"""Registry of queries and of the DuckDB SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landledger.session import pin_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    """Named SQL block other blocks and oracles may select from."""
    CTES[name] = body


def with_ctes(body: str) -> str:
    """Put the blocks the SQL mentions, directly or not, in front of it."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bb_[a-z_0-9]+\b", text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {blocks}\n{body}"


def query(key: str, sql: str | None = None):
    """Register a query function and its oracle."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(pin_settings(spark), sf_dir)

        run.__name__ = key
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_ctes(sql)
        return build

    return register
