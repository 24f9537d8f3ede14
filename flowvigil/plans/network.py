"""Network log lines to documents, messages and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.operators.deadletter import dead_letters, fail_on_error, parse_network
from flowvigil.operators.http import complete, drop_static
from flowvigil.operators.netflow import explode_records, typed_records
from flowvigil.operators.netflow_messages import json_messages
from flowvigil.operators.route import is_http
from flowvigil.operators.rules import Rule, match_rules, rule_rows
from flowvigil.operators.uri_flows import flow_messages
from flowvigil.sources.sinks import documents


@dataclass(frozen=True)
class NetworkTables:
    """Everything one set of lines gives. All of it is lazy and starts at ``lines``."""

    flows: DataFrame
    records: DataFrame
    letters: DataFrame

    def documents(self) -> DataFrame:
        return documents(self.flows, "id").unionByName(documents(self.records, "recordid"))

    def flow_messages(self) -> DataFrame:
        return flow_messages(self.flows)

    def netflow_messages(self) -> DataFrame:
        return json_messages(self.records)


def network_tables(
    lines: DataFrame,
    rules: DataFrame | Sequence[Rule],
    value: str = "value",
    strict: bool = False,
    id_mode: str = "hash",
) -> NetworkTables:
    """Route, parse and match rules; see :func:`tables_of`.

    Flows and records each parse their own lines alone, so whoever reads both
    parses no line twice. ``strict`` parses all lines for either, and fails on any.
    """
    if strict:
        return tables_of(parse_network(lines, value), rules, value, strict, id_mode)
    http = is_http(F.col(value))
    return NetworkTables(
        _flows(parse_network(lines.where(http), value), rules, value, strict, id_mode),
        _records(parse_network(lines.where(~http), value), value, strict, id_mode),
        dead_letters(parse_network(lines, value), "network", value),
    )


def tables_of(
    parsed: DataFrame,
    rules: DataFrame | Sequence[Rule],
    value: str = "value",
    strict: bool = False,
    id_mode: str = "hash",
) -> NetworkTables:
    """Tables of lines that ``parse_network`` has been over. Whoever reads more than
    one of them stores the parsed lines first, and no line is parsed twice.

    A line with an error is a dead letter and nothing else, a bad date included;
    ``strict`` fails on it instead.
    """
    return NetworkTables(
        _flows(parsed, rules, value, strict, id_mode),
        _records(parsed, value, strict, id_mode),
        dead_letters(parsed, "network", value),
    )


def _good(parsed: DataFrame, wanted: Column, strict: bool) -> DataFrame:
    error = F.col("error").isNotNull()
    # In strict mode the filter lets errors through: it may run first.
    if strict:
        return fail_on_error(parsed.where(wanted | error))
    return parsed.where(wanted & ~error).drop("error")


def _flows(
    parsed: DataFrame, rules: DataFrame | Sequence[Rule], value: str, strict: bool, id_mode: str
) -> DataFrame:
    http = _good(parsed, F.col("http") & F.col("flowcontent").isNotNull(), strict).drop("http", "records")
    flows = complete(drop_static(http), value, id_mode)
    return rule_rows(match_rules(flows, rules)).drop(value)


def _records(parsed: DataFrame, value: str, strict: bool, id_mode: str) -> DataFrame:
    netflow = _good(parsed, F.col("records").isNotNull(), strict).drop("http", "flowcontent")
    return typed_records(explode_records(netflow, value, id_mode))
