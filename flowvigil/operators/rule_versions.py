"""Rules that change: which version of a rule was valid when a flow was seen.

A version holds from its ``valid_from`` (epoch seconds) up to the next version of
the same rule. One without an expression withdraws the rule. Flows are matched
with the versions of their own time, so that a day that is computed again gives
what it gave, and an alert names a rule that was in force.

Versions are constants of the plan like plain rules are, each with its bounds:
flows are neither joined nor shuffled. A stream reads the table of versions again
for each batch, and takes up what changed without a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowvigil.operators.rules import Rule, rules_in_order, usable_rules


def dated_rules(versions: DataFrame, rule: str = "ruleid", since: str = "valid_from") -> DataFrame:
    """Versions with ``valid_to``, the start of the next one; null where none follows.

    A null start is before all others. Of versions of a rule with one start the
    last by its columns holds. Withdrawals end the version before them and go.
    """
    rest = [F.col(name).asc_nulls_first() for name in sorted(versions.columns) if name not in (rule, since)]
    in_time = Window.partitionBy(rule).orderBy(F.col(since).asc_nulls_first(), *rest)
    follower = F.lead(F.struct(F.col(since).alias("start"))).over(in_time)
    ended = versions.withColumn("_next", follower)
    # A follower that starts with the version, or before all time, leaves nothing of it.
    empty = F.col("_next").isNotNull() & F.col("_next.start").eqNullSafe(F.col(since))
    kept = ended.where(~empty & F.col("rule_regular_expression").isNotNull())
    return kept.withColumn("valid_to", F.col("_next.start")).drop("_next")


class RuleFeed:
    """The usable rules of a table that changes under a stream.

    ``read`` opens the table anew at each call; expressions are tried again only
    when the table has changed.
    """

    def __init__(
        self, read: Callable[[], DataFrame], on_bad_rule: str = "skip", order: str = "rule_pos"
    ) -> None:
        self._read, self._on_bad_rule, self._order = read, on_bad_rule, order
        self._seen: list[Rule] | None = None
        self._usable: list[Rule] = []

    def __call__(self) -> list[Rule]:
        table = self._read()
        seen = list(rules_in_order(table, self._order))
        if seen != self._seen:
            self._usable = usable_rules(table.sparkSession, seen, self._on_bad_rule)
            self._seen = seen
        return self._usable
