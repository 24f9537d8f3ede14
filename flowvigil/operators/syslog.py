"""Vendor syslog to syslog and genlog rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import captured_groups, epoch_now, java_hash, once, origin_of, parse_time, record_id

# The envelope and the columns of a genlog row.
DELIMITER = r"\|\!"
REPORT_IP_FIELD = 29
SHORT_TAIL = 5
ABSENT = " "
GENLOG_COLUMNS = (
    "row",
    "recordid",
    "actionresult",
    "firstrecvtime",
    "reprotapp",
    "reportid",
    "sourceip",
    "sourceport",
    "destport",
    "destip",
    "eventaction",
    "reportnetype",
    "eventdefid",
    "eventname",
    "eventname2",
    "eventname3",
    "appproto",
    "getparameter",
    "orglog",
    "logruleid",
    "eventlevel",
    "orgid",
    "url",
)
ROW_SCHEMA = (
    "es_index string, es_type string, recordid string, reportapp string, reportip string, "
    "row string, recvtime bigint, storagetime bigint, ismatch int, logcontent string, "
    "logruleid string, orglog string, orgid string, actionresult string, firstrecvtime bigint, "
    "reprotapp string, reportid string, sourceip string, sourceport string, destport string, "
    "destip string, eventaction string, reportnetype string, eventdefid string, "
    "eventname string, eventname2 string, eventname3 string, appproto string, "
    "getparameter string, eventlevel string, url string"
)


@dataclass(frozen=True)
class SyslogPattern:
    """A vendor format: its regular expression and the group of each field.

    ``requires`` lists texts without which the expression cannot match. They are
    tested first, because a substring search is far cheaper than backtracking.
    ``optional`` names the fields whose group may take no part in a match; they
    are null then.
    """

    id: str
    pattern: str
    fields: tuple[tuple[str, int], ...]
    requires: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    @property
    def search_pattern(self) -> str:
        """The same expression, tried once per text line.

        A leading ``.*`` or ``.+`` that matches from some position also matches
        from the start of that line, so later starts are wasted work.
        """
        if self.pattern.startswith((".*", ".+")) and not set("|^$") & set(self.pattern):
            return "(?m)^" + self.pattern
        return self.pattern

    def found_in(self, text: Column) -> Column:
        found = text.rlike(self.search_pattern)
        for required in reversed(self.requires):
            found = text.contains(required) & found
        return found


def envelope(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reportip`` and ``orglog``; a line of too few fields leaves ``reportip`` null.

    Empty fields at the end do not count. ``orglog`` is the last field, or the
    one before it if the last is shorter than five characters.
    """
    trimmed = F.regexp_replace(F.col(value), rf"(?:{DELIMITER})+\z", "")
    fields = F.col("_fields")
    last = F.element_at(fields, -1)
    before_last = F.get(fields, F.size(fields) - 2)
    return (
        once(lines, "_fields", F.split(trimmed, DELIMITER))
        .withColumn("reportip", F.get(fields, F.lit(REPORT_IP_FIELD)))
        .withColumn("orglog", F.when(F.length(last) < SHORT_TAIL, before_last).otherwise(last))
        .drop("_fields")
    )


def classify(
    lines: DataFrame, patterns: Sequence[SyslogPattern], value: str = "value"
) -> DataFrame:
    """Add ``logruleid``: the first pattern found in the line, else null."""
    cases = F
    for pattern in patterns:
        cases = cases.when(pattern.found_in(F.col(value)), F.lit(pattern.id))
    first = cases if patterns else F.lit(None).cast("string")
    return once(lines, "logruleid", first)


def _captures(patterns: Sequence[SyslogPattern], value: str) -> Column:
    """Fields of the winning pattern as an array, in the order the pattern names them."""
    cases = F.when(F.lit(False), F.array().cast("array<string>"))
    for pattern in patterns:
        groups = [group for _, group in pattern.fields]
        captured = captured_groups(F.col(value), pattern.search_pattern, groups)
        cases = cases.when(F.col("logruleid") == pattern.id, captured)
    return cases


def _captured(patterns: Sequence[SyslogPattern], name: str) -> Column | None:
    """One field out of the captures, or None if no pattern has it."""
    cases = None
    for pattern in patterns:
        names = [field for field, _ in pattern.fields]
        if name not in names:
            continue
        taken = F.col("_captures")[names.index(name)]
        if name in pattern.optional:
            taken = F.nullif(taken, F.lit(""))
        chosen = F.col("logruleid") == pattern.id
        cases = F.when(chosen, taken) if cases is None else cases.when(chosen, taken)
    return cases


def genlog_fields(
    classified: DataFrame,
    patterns: Sequence[SyslogPattern],
    value: str = "value",
    now: int | None = None,
) -> DataFrame:
    """Add the genlog columns the winning pattern fills, blank where it does not.

    ``firstrecvtime`` is in milliseconds and falls back on the current time;
    ``eventname3`` is derived from ``eventname``.
    """
    computed = ("row", "recordid", "orglog", "logruleid", "orgid", "firstrecvtime", "eventname3")
    columns = []
    for name in GENLOG_COLUMNS:
        if name in computed:
            continue
        captured = _captured(patterns, name)
        has_field = F.col("logruleid").isin(
            *[pattern.id for pattern in patterns if name in dict(pattern.fields)]
        )
        filled = F.lit(ABSENT)
        if captured is not None:
            filled = F.when(has_field, captured).otherwise(F.lit(ABSENT))
        columns.append(filled.alias(name))
    time_text = _captured(patterns, "firstrecvtime")
    event = _captured(patterns, "eventname")
    with_text = once(classified, "_captures", _captures(patterns, value)).select(
        "*",
        *columns,
        (F.lit(None).cast("string") if time_text is None else time_text).alias("_time_text"),
        (F.lit(None).cast("string") if event is None else event).alias("_event"),
    )
    received = F.when(F.col("_time_text").isNull(), epoch_now(now)).otherwise(
        parse_time(F.col("_time_text"))
    )
    hashed = F.concat(java_hash(F.col("_event")).cast("string"), F.lit("hashcode"))
    return (
        with_text.withColumn("firstrecvtime", received * 1000)
        .withColumn("eventname3", F.coalesce(hashed, F.lit(ABSENT)))
        .drop("_captures", "_time_text", "_event")
    )


def syslog_rows(
    lines: DataFrame,
    patterns: Sequence[SyslogPattern],
    value: str = "value",
    now: int | None = None,
    id_mode: str = "hash",
) -> DataFrame:
    """One ``syslog`` row per line, and a ``genlog`` row for a line that matched.

    ``orgid`` of the genlog row is ``recordid`` of its syslog row. Lines whose
    envelope is broken are left out; see :func:`flowvigil.operators.deadletter.syslog_errors`.
    """
    text = F.col(value)
    parsed = genlog_fields(
        classify(envelope(lines, value), patterns, value).where(F.col("reportip").isNotNull()),
        patterns,
        value,
        now,
    )
    ids = parsed.withColumn("_syslog_id", record_id(id_mode, *origin_of(parsed), text, F.lit("syslog"))).withColumn(
        "_genlog_id", record_id(id_mode, *origin_of(parsed), text, F.lit("genlog"))
    )
    seen = F.lit(None).cast("bigint") if now is None else F.lit(now * 1000).cast("bigint")
    arrived = F.coalesce(seen, F.unix_millis(F.current_timestamp()))
    matched = F.col("logruleid").isNotNull()
    shared = {"reportapp": F.lit("SYSLOG_LOG"), "reportip": F.col("reportip")}
    syslog = {
        **shared,
        "es_index": F.lit("syslog"),
        "es_type": F.lit("syslog"),
        "recordid": F.col("_syslog_id"),
        "row": F.lit(ABSENT),
        "recvtime": arrived,
        "storagetime": arrived,
        "ismatch": matched.cast("int"),
        "logcontent": text,
    }
    genlog = {
        **{name: F.col(name) for name in GENLOG_COLUMNS if name in ids.columns},
        **shared,
        "es_index": F.lit("genlog"),
        "es_type": F.lit("genlog"),
        "recordid": F.col("_genlog_id"),
        "row": F.lit(ABSENT),
        "orgid": F.col("_syslog_id"),
    }
    names = [part.split()[0] for part in ROW_SCHEMA.split(", ")]

    def row(values: dict[str, Column]) -> Column:
        present = [values.get(name, F.lit(None)).alias(name) for name in names]
        return F.struct(*present).cast(f"struct<{ROW_SCHEMA.replace(' ', ':').replace(',:', ',')}>")

    rows = F.when(matched, F.array(row(syslog), row(genlog))).otherwise(F.array(row(syslog)))
    return ids.select(F.explode(rows).alias("_row")).select("_row.*")
