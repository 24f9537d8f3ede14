"""The scheduled jobs: which tables they read, and what they leave behind.

The streams are in :mod:`flowvigil.streaming`; ``now`` is the second a job is
scheduled for, so that a rerun reads and writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from flowvigil.operators.alerts import alerts_by_record, injection_alerts
from flowvigil.operators.features import (
    GROUP_KEYS,
    attack_features,
    netflow_features,
    recent_records,
)
from flowvigil.operators.sampling import attack_training_set, netflow_training_set
from flowvigil.operators.uri_flows import counted_rows, recent_queries, training_rows
from flowvigil.plans.models import load_model, save_model
from flowvigil.plans.netflow_model import NetflowModelSettings, train_netflow_model
from flowvigil.plans.uri_model import TextModelSettings, train_text_model
from flowvigil.sources.sinks import Target
from flowvigil.sources.tables import Source, bounded, flows_of, read_attack_csv, records_of


def train_uri_model(
    spark: SparkSession,
    labelled: Source,
    model_path: str,
    settings: TextModelSettings | None = None,
    lexicon: Sequence[str] = (),
) -> PipelineModel:
    """Learn from a table of (label, uri)."""
    model = train_text_model(counted_rows(training_rows(labelled.read(spark), lexicon)), settings)
    save_model(model, model_path)
    return model


def score_recent_uris(
    spark: SparkSession,
    flows: Source,
    model_path: str,
    alerts: Target,
    now: int,
    days: int = 1,
    lexicon: Sequence[str] = (),
) -> None:
    """Write alerts for the flows of the last day; ``flows`` may be stored documents."""
    recent = recent_queries(flows_of(flows.read(spark)), now, days, lexicon)
    alerts.write(injection_alerts(load_model(model_path).transform(recent)))


def build_netflow_features(
    spark: SparkSession,
    records: Source,
    features: Target,
    max_input_rows: int | None = None,
) -> None:
    """Append the features of all records, or of at most ``max_input_rows`` of them;
    ``records`` may be stored documents."""
    rows = bounded(records_of(records.read(spark)), max_input_rows, ["recordid"])
    features.write(netflow_features(rows))


def build_attack_features(
    spark: SparkSession,
    captures: Sequence[tuple[str, str]],
    features: Target,
    schema: str | None = None,
) -> None:
    """Append the features of (CSV path, label) captures. Without ``schema`` the
    types are inferred, which reads the files twice."""
    for path, label in captures:
        features.write(attack_features(read_attack_csv(spark, path, schema), label))


def build_attack_training_set(
    spark: SparkSession, attacks: Source, normal: Source, training: Target
) -> None:
    """Balance stored attack features and add normal ones."""
    training.write(attack_training_set(attacks.read(spark), normal.read(spark), GROUP_KEYS))


def train_conversation_model(
    spark: SparkSession,
    attacks: Sequence[Source],
    normal: Source,
    model_path: str,
    normal_percent: int = 5,
    settings: NetflowModelSettings | None = None,
) -> PipelineModel:
    """Learn from stored attack features and a sample of the normal ones."""
    training = netflow_training_set(
        [source.read(spark) for source in attacks], normal.read(spark), normal_percent, GROUP_KEYS
    )
    model = train_netflow_model(training, settings)
    save_model(model, model_path)
    return model


def score_recent_conversations(
    spark: SparkSession,
    records: Source,
    model_path: str,
    alerts: Target,
    now: int,
    days: int = 2,
    shape: Callable[[DataFrame, DataFrame], DataFrame] = alerts_by_record,
    port_lists: bool = False,
) -> None:
    """Write alerts for the conversations of the last two days; ``records`` may be
    stored documents. ``shape`` makes alerts of scored conversations and recent
    records. Alerts per pair of ports are the product of two lists; to have them,
    pass ``lambda scored, _: alerts_by_ports(scored)`` and ``port_lists``."""
    recent = recent_records(records_of(records.read(spark)), now, days)
    features = netflow_features(recent, port_lists=port_lists)
    alerts.write(shape(load_model(model_path).transform(features), recent))
