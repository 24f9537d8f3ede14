"""Lines that do not parse, kept instead of failing a whole batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import json_object, once, parse_time
from flowvigil.operators.http import JSON_SPAN
from flowvigil.operators.netflow import RECORD_SPAN
from flowvigil.operators.route import HTTP_MARKERS, is_http
from flowvigil.operators.syslog import DELIMITER, REPORT_IP_FIELD


def parse_network(
    lines: DataFrame, value: str = "value", markers: Sequence[str] = HTTP_MARKERS
) -> DataFrame:
    """Route and parse each line once.

    Adds ``http``, ``flowcontent`` (the object of an HTTP line as a map),
    ``records`` (those of a netflow line) and ``error``: why a line does not
    parse. That is null for lines that do, and for lines without a payload.
    """
    text = F.col(value)
    routed = once(lines, "http", is_http(text, markers))
    flow = json_object(F.regexp_extract(text, JSON_SPAN, 1))
    records = F.from_json(F.regexp_extract(text, RECORD_SPAN, 1), "array<map<string,string>>")
    has_flow = F.col("http") & text.rlike(JSON_SPAN)
    has_records = ~F.col("http") & text.rlike(RECORD_SPAN)
    parsed = F.struct(
        has_flow.alias("has_flow"),
        has_records.alias("has_records"),
        F.when(has_flow, flow).alias("flow"),
        F.when(has_records, records).alias("records"),
    )
    result = F.col("_parsed")
    dates = F.map_values(F.map_filter(result["flow"], lambda key, _: F.lower(key) == "date"))
    # A list of one element names the date, which is looked up once and not for each use.
    date = F.transform(F.array(F.try_element_at(dates, F.lit(-1))), parse_time)
    bad_date = (F.size(dates) > 0) & F.get(date, 0).isNull()
    error = (
        F.when(result["has_flow"] & result["flow"].isNull(), "http payload is no JSON object")
        .when(result["has_flow"] & bad_date, "http date has fewer than ten digits")
        .when(
            result["has_records"] & result["records"].isNull(),
            "netflow payload is no JSON array of objects",
        )
    )
    checked = once(once(routed, "_parsed", parsed), "error", error)
    return checked.select(
        *[name for name in lines.columns],
        "http",
        result["flow"].alias("flowcontent"),
        result["records"].alias("records"),
        "error",
    )


def network_errors(
    lines: DataFrame, value: str = "value", markers: Sequence[str] = HTTP_MARKERS
) -> DataFrame:
    """Add ``error`` of ``parse_network``."""
    return parse_network(lines, value, markers).drop("http", "flowcontent", "records")


def syslog_errors(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``error`` for lines whose envelope is too short."""
    trimmed = F.regexp_replace(F.col(value), rf"(?:{DELIMITER})+\z", "")
    fields = F.size(F.split(trimmed, DELIMITER))
    too_short = F.when(fields <= REPORT_IP_FIELD, "syslog line has fewer than thirty fields")
    return once(lines, "error", too_short)


def dead_letters(
    checked: DataFrame, stage: str, value: str = "value", now: str | None = None
) -> DataFrame:
    """Envelopes ``{time, error, stage, log}`` of the lines with an error."""
    time = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if now is None else F.lit(now)
    return checked.where(F.col("error").isNotNull()).select(
        time.alias("time"), "error", F.lit(stage).alias("stage"), F.col(value).alias("log")
    )


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    """The envelopes as JSON messages."""
    body = F.to_json(F.struct(*letters.columns))
    return letters.select(F.lit(None).cast("string").alias("key"), body.alias("value"))


def fail_on_error(checked: DataFrame) -> DataFrame:
    """Strict mode: the first line with an error fails the job, whatever filters follow."""
    error = F.col("error")
    good = F.when(error.isNotNull(), F.raise_error(error).cast("boolean")).otherwise(True)
    return once(checked, "_good", good).where("_good").drop("_good", "error")
