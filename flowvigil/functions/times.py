"""Text to epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_APACHE = r"^[ \t]*(\d{1,2}/[A-Za-z]{3,9}/\d{4}:\d{1,2}:\d{1,2}:\d{1,2})"
_ISO = r"^[ \t]*(\d{4}-\d{1,2}-\d{1,2} [ \t]*\d{1,2}:\d{1,2}:\d{1,2})"


def _first_ten_of_millis(stamp: Column) -> Column:
    """Seconds as log stores keep them: the first ten characters of the millis.

    Equal to the epoch second from 2001-09-09 on; earlier instants have shorter
    millis and keep a digit too many. Millis below ten characters count as 0.
    """
    millis = (F.unix_timestamp(stamp) * 1000).cast("string")
    return F.when(F.length(millis) >= 10, F.substring(millis, 1, 10).cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )


def parse_time(text: Column) -> Column:
    """Epoch seconds of a log time stamp, 0 where the text holds no time.

    All digits: the first ten of them (null below ten digits, which callers send
    to the dead letters). Otherwise the text has to begin with
    ``dd/MMM/yyyy:HH:mm:ss`` or ``yyyy-MM-dd HH:mm:ss`` in the session time zone;
    what follows is ignored. Dates that do not exist give 0.
    """
    apache = F.regexp_extract(text, _APACHE, 1)
    iso = F.regexp_replace(F.regexp_extract(text, _ISO, 1), r"[ \t]+", " ")
    # Each layout is tried on texts of its shape alone: a failed parse costs an exception.
    stamp = F.when(
        text.rlike(_APACHE),
        F.coalesce(
            F.try_to_timestamp(apache, F.lit("d/MMM/yyyy:H:m:s")),
            F.try_to_timestamp(apache, F.lit("d/MMMM/yyyy:H:m:s")),
        ),
    ).when(text.rlike(_ISO), F.try_to_timestamp(iso, F.lit("yyyy-M-d H:m:s")))
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(
            text.rlike(r"^\d+$"),
            F.when(F.length(text) >= 10, F.substring(text, 1, 10).cast("bigint")),
        )
        .otherwise(F.coalesce(_first_ten_of_millis(stamp), F.lit(0).cast("bigint")))
    )


def epoch_now(now: int | None = None) -> Column:
    """Current epoch second, or the fixed one a rerun has to reproduce."""
    return F.unix_timestamp() if now is None else F.lit(now).cast("bigint")
