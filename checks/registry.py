"""Queries by name, each with the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_CTES = {
    "fx_netflow": fx.SQL_NETFLOW,
    "fx_http": fx.SQL_HTTP,
    "fx_syslog": fx.SQL_SYSLOG,
    "fx_attack": fx.SQL_ATTACK,
}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``fx_*`` tables in its SQL become common table expressions."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return function

    return register


def with_fixtures(sql: str) -> str:
    used = [
        f"{name} as ({select.strip()})"
        for name, select in _CTES.items()
        if name in sql
    ]
    ctes = ",\n".join(used).replace("{EPOCH}", fx.DUCKDB_EPOCH)
    if not used:
        return sql.strip()
    body = sql.strip()
    recursive = "with recursive "
    if body.lower().startswith(recursive):
        return f"{recursive}{ctes},\n{body[len(recursive):]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
