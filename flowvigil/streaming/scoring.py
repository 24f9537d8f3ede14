"""Streams that score flows and conversations and write the alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowvigil.operators.alerts import NORMAL, alerts_by_record, injection_alerts
from flowvigil.operators.deadletter import dead_letters
from flowvigil.operators.features import netflow_features
from flowvigil.operators.netflow_messages import json_message_errors, parse_json_messages
from flowvigil.operators.uri_flows import parse_flow_messages
from flowvigil.plans.models import ModelFeed
from flowvigil.sources.sinks import Target
from flowvigil.streaming.run import StreamOptions, stored
from flowvigil.streaming.windows import session_features, windowed_features


def seen_once(rows: DataFrame, ids: Sequence[str], event_time: str, within: str) -> DataFrame:
    """The first row of each id. Ids are forgotten ``within`` after they were seen,
    by event time; rows later than that, or without a time, are left out."""
    return rows.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(ids))


def start_uri_scoring(
    messages: DataFrame,
    model: PipelineModel | ModelFeed,
    target: Target,
    options: StreamOptions,
    lexicon: Sequence[str] = (),
    once_within: str | None = None,
) -> StreamingQuery:
    """Flow messages to injection alerts. Scoring is part of the stream itself.

    With ``once_within`` a message that comes again within that time, be it in
    another batch or after a restart, gives no second alert: messages of one id
    are one (:func:`seen_once`).

    A feed of models is asked for the newest version at each batch, and the alerts
    carry it as ``model_version``. A batch that is run again may find a newer one;
    file targets then hold that version's alerts alone.
    """
    flows = parse_flow_messages(messages, lexicon=lexicon)
    if once_within is not None:
        timed = flows.withColumn("_seen", F.timestamp_seconds("date"))
        flows = seen_once(timed, ["id"], "_seen", once_within).drop("_seen")
    if not isinstance(model, ModelFeed):
        return options.start(injection_alerts(model.transform(flows)), target.write_batch)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        version, newest = model()
        alerts = injection_alerts(newest.transform(batch))
        target.write_batch(alerts.withColumn("model_version", F.lit(version)), batch_id)

    return options.start(flows, each_batch)


def _as_they_are(records: DataFrame) -> DataFrame:
    return records


def start_netflow_scoring(
    messages: DataFrame,
    model: PipelineModel,
    target: Target,
    options: StreamOptions,
    parse: Callable[[DataFrame], DataFrame] = parse_json_messages,
    letters: Target | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Netflow messages to one alert per record of an attack conversation.

    Conversations are grouped within a micro-batch; see
    :func:`start_window_scoring` for groups across batches. JSON messages that do
    not parse go to ``letters``, if there is such a target.

    With ``once_within`` a record that comes again within that time is neither
    counted nor alerted again (:func:`seen_once`, by ``recordid`` and
    ``starttime``). Dead letters have no id: they need a stream of their own then.
    """
    if once_within is not None:
        if letters is not None:
            raise ValueError("give letters to a stream of their own, without once_within")
        timed = parse(messages).withColumn("_seen", F.timestamp_seconds("starttime"))
        once = seen_once(timed, ["recordid"], "_seen", once_within).drop("_seen")
        # Joined with itself, a batch that is laid out by id is not found among the stored tables, and
        # the state would be gone through twice. Coalescing, if only to as many tasks, drops that layout.
        tasks = options.state or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        messages = once.coalesce(tasks)
        parse = _as_they_are

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if letters is not None:
            letters.write_batch(dead_letters(json_message_errors(batch), "netflow"), batch_id)
        with stored(parse(batch)) as (records,):
            scored = model.transform(netflow_features(records, port_lists=False))
            target.write_batch(alerts_by_record(scored, records), batch_id)

    return options.start(messages, each_batch)


def start_window_scoring(
    messages: DataFrame,
    model: PipelineModel,
    target: Target,
    options: StreamOptions,
    width: str,
    delay: str,
    event_time: str = "starttime",
    parse: Callable[[DataFrame], DataFrame] = parse_json_messages,
    sessions: bool = False,
) -> StreamingQuery:
    """Netflow messages to one alert per attack conversation and window.

    Conversations are grouped over batches, by event time; a window is scored
    when the watermark has passed it. Scoring is part of the stream itself. With
    ``sessions`` a window lasts until the conversation has paused for ``width``.
    """
    records = parse(messages).withColumn("event_time", F.timestamp_seconds(event_time))
    grouped = session_features if sessions else windowed_features
    scored = model.transform(grouped(records, "event_time", width, delay))
    alerts = scored.where(F.col("predictedLabel") != NORMAL).select(
        "window_start", "window_end", "srcip", "dstip", "proto",
        F.col("predictedLabel").alias("attacktype"),
        "spandtime", "packernum", "bytesize", "flownum", "src_flow_port_num", "dst_flow_port_num",
    )
    return options.start(alerts, target.write_batch)
