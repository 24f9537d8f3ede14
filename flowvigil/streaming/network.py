"""Stream of network log lines: documents, flow and netflow messages, dead letters."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowvigil.operators.deadletter import parse_network
from flowvigil.operators.rule_versions import RuleFeed
from flowvigil.operators.rules import resolve_rules
from flowvigil.plans.network import tables_of
from flowvigil.session import written
from flowvigil.sources.sinks import Target
from flowvigil.streaming.run import StreamOptions, write_outputs

log = logging.getLogger(__name__)

#: Outputs that read a table: it is written if several of them are wanted.
READERS = {"flows": {"documents", "flow_messages"}, "records": {"documents", "netflow_messages"}}


def start_network_etl(
    lines: DataFrame,
    rules: DataFrame | RuleFeed,
    targets: Mapping[str, Target],
    options: StreamOptions,
    strict: bool = False,
) -> StreamingQuery:
    """``targets`` by output: documents, flow_messages, netflow_messages, letters.

    A table of rules is resolved once, before the first batch; a feed is asked for
    its rules at each batch.
    """
    feed = rules if isinstance(rules, RuleFeed) else None
    fixed = resolve_rules(rules) if feed is None else []

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if not targets:
            return
        seen = Observation(f"network-{batch_id}")
        counted = batch.observe(seen, F.count(F.lit(1)).alias("lines"))
        with written("parsed", parse_network(counted)) as (kept,):
            tables = tables_of(kept, fixed if feed is None else feed(), strict=strict)
            shared = [name for name, readers in READERS.items() if readers <= set(targets)]
            with written("network", *[getattr(tables, name) for name in shared]) as found:
                tables = replace(tables, **dict(zip(shared, found, strict=True)))
                outputs = {
                    "documents": tables.documents(),
                    "flow_messages": tables.flow_messages(),
                    "netflow_messages": tables.netflow_messages(),
                    "letters": tables.letters,
                }
                write_outputs(outputs, targets, batch_id)
                log.info("batch %d: %s lines", batch_id, seen.get["lines"])

    return options.start(lines, each_batch)
