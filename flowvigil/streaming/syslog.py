"""Stream of vendor syslog: syslog and genlog rows, dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowvigil.operators.deadletter import dead_letters, syslog_errors
from flowvigil.operators.syslog import SyslogPattern, syslog_rows
from flowvigil.sources.sinks import Target
from flowvigil.streaming.run import StreamOptions, stored, write_outputs


def start_syslog_etl(
    lines: DataFrame,
    patterns: Sequence[SyslogPattern],
    targets: Mapping[str, Target],
    options: StreamOptions,
    now: int | None = None,
) -> StreamingQuery:
    """``targets`` by output: rows, letters."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        with stored(batch) as (kept,):
            outputs = {
                "rows": syslog_rows(kept, patterns, now=now),
                "letters": dead_letters(syslog_errors(kept), "syslog"),
            }
            write_outputs(outputs, targets, batch_id)

    return options.start(lines, each_batch)
