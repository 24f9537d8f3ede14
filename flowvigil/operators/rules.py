"""First rule that an HTTP flow hits."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.functions import once, uri_decode
from flowvigil.operators.rule_index import RuleIndex

log = logging.getLogger(__name__)

#: Rules per CASE expression.
RULES_PER_CASE = 100
#: So many rules are tried one by one; more are filed by the literals they need.
INDEX_FROM = 200

# Fixed value: only an address written with this counts as an address, see ``ip_match``.
ESCAPED_DOT = "\\."


@dataclass(frozen=True)
class Rule:
    """``since`` and ``until`` are epoch seconds, the end not included; None is open."""

    ruleid: str
    sourceip: str
    destip: str
    pattern: str
    since: int | None = None
    until: int | None = None


def rules_in_order(rules: DataFrame, order: str = "rule_pos") -> Iterator[Rule]:
    """Rules by priority, fetched one partition at a time.

    A rule with a missing value is an error of the rule table and stops here. The
    columns ``valid_from`` and ``valid_to`` may be absent, and null in any row.
    """
    columns = ("ruleid", "sourceip", "destip", "rule_regular_expression")
    bounds = [name for name in ("valid_from", "valid_to") if name in rules.columns]
    for row in rules.orderBy(order, *bounds).select(*columns, *bounds).toLocalIterator():
        needed = [row[column] for column in columns]
        if None in needed:
            raise ValueError(f"rule with a missing value: {row}")
        since, until = (row[name] if name in bounds else None for name in ("valid_from", "valid_to"))
        yield Rule(*map(str, needed), since, until)


def _compiles(spark: SparkSession, patterns: Sequence[str]) -> bool:
    tests = ", ".join(f"'' rlike {_sql_text(pattern)}" for pattern in patterns)
    try:
        spark.range(1).select(F.expr(f"array({tests})")).collect()
    except PySparkException:
        return False
    return True


def usable_rules(spark: SparkSession, rules: Sequence[Rule], on_bad_rule: str) -> list[Rule]:
    """Leave out rules whose pattern does not compile.

    ``skip`` drops the bad rule alone; ``stop`` drops every rule after it as
    well, the way a matcher behaves that fails when it reaches the bad rule.
    """
    if not rules or _compiles(spark, [rule.pattern for rule in rules]):
        return list(rules)
    if len(rules) == 1:
        log.warning("rule %s left out: bad pattern %r", rules[0].ruleid, rules[0].pattern)
        return []
    middle = len(rules) // 2
    first = usable_rules(spark, rules[:middle], on_bad_rule)
    if on_bad_rule == "stop" and len(first) < middle:
        return first
    return first + usable_rules(spark, rules[middle:], on_bad_rule)


def resolve_rules(
    rules: DataFrame, on_bad_rule: str = "skip", order: str = "rule_pos"
) -> list[Rule]:
    """The usable rules by priority. A stream resolves them once, when it starts."""
    return usable_rules(rules.sparkSession, list(rules_in_order(rules, order)), on_bad_rule)


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _wanted_address(wanted: str, ip_match: str) -> str | None:
    """The address a rule asks for, or None where it takes any.

    ``escaped``: a rule address without a backslash-dot is a wildcard, however
    it is written, and one with it can only equal itself. ``strict``: anything
    but ``any``, ``*`` and the empty text must be equal.
    """
    if ip_match == "escaped":
        wildcard = ESCAPED_DOT not in wanted
    elif ip_match == "strict":
        wildcard = wanted.strip().lower() in ("", "*", "any")
    else:
        raise ValueError(f"ip_match is 'escaped' or 'strict', not {ip_match!r}")
    return None if wildcard else wanted


def _address_test(address: str, wanted: str, ip_match: str) -> str | None:
    only = _wanted_address(wanted, ip_match)
    return None if only is None else f"{address} = {_sql_text(only)}"


def _hit(rule: Rule, ip_match: str) -> str:
    tests = [
        None if rule.since is None else f"_time >= {rule.since}L",
        None if rule.until is None else f"_time < {rule.until}L",
        _address_test("srcip", rule.sourceip, ip_match),
        _address_test("dstip", rule.destip, ip_match),
        f"_decoded rlike {_sql_text(rule.pattern)}",
    ]
    return " and ".join(test for test in tests if test is not None)


def _first_hit(rules: Sequence[Rule], places: Sequence[int], ip_match: str) -> Column:
    """The place of the first rule that hits: one SQL text, whose parser reads thousands in a second."""
    cases = []
    for start in range(0, len(places), RULES_PER_CASE):
        whens = [
            f"when {_hit(rules[place], ip_match)} then {place}"
            for place in places[start : start + RULES_PER_CASE]
        ]
        cases.append(f"case {' '.join(whens)} end")
    return F.expr(f"coalesce({', '.join(cases)})") if cases else F.lit(None).cast("int")


def _hit_place(rules: Sequence[Rule], ip_match: str, index_from: int, dated: bool) -> Column:
    if len(rules) < index_from:
        return _first_hit(rules, range(len(rules)), ip_match)
    index = RuleIndex(
        rules,
        source=lambda rule: _wanted_address(rule.sourceip, ip_match),
        target=lambda rule: _wanted_address(rule.destip, ip_match),
    )
    time = F.col("_time") if dated else None
    filed = index.first_place(F.col("_decoded"), F.col("srcip"), F.col("dstip"), time)
    return F.least(filed, _first_hit(rules, index.unfiled, ip_match))


def match_rules(
    flows: DataFrame,
    rules: DataFrame | Sequence[Rule],
    ip_match: str = "escaped",
    on_bad_rule: str = "skip",
    order: str = "rule_pos",
    uri: Column | None = None,
    index_from: int = INDEX_FROM,
    time: Column | None = None,
) -> DataFrame:
    """Add ``ruleid`` of the first rule the flow hits, else null.

    The rules, a table or what ``resolve_rules`` made of it, become constants of
    one expression: flows are neither joined nor shuffled nor stored. A few rules
    are tried one by one, their patterns compiled once per task; from
    ``index_from`` rules on, a flow tries those alone whose literals it holds.
    ``uri`` is the address that is matched, by default the column; pass
    ``flowcontent['Uri']`` to match flows only whose key is written in exactly
    this way.

    Rules with a validity (see :mod:`flowvigil.operators.rule_versions`) hit only
    flows of that time, by default the epoch seconds in ``date``; a flow without a
    time is hit by no rule that has a bound.
    """
    resolved = resolve_rules(rules, on_bad_rule, order) if isinstance(rules, DataFrame) else rules
    decoded = uri_decode(F.col("uri") if uri is None else uri)
    matched = once(flows, "_decoded", decoded)
    dated = any(rule.since is not None or rule.until is not None for rule in resolved)
    if dated:
        seconds = F.col("date") if time is None else time
        matched = matched.withColumn("_time", seconds.cast("bigint"))
    placed = once(matched, "_place", _hit_place(resolved, ip_match, index_from, dated))
    names = F.from_json(F.lit(json.dumps([rule.ruleid for rule in resolved])), "array<string>")
    ruleid = F.when(F.col("_place").isNotNull(), F.element_at(names, F.col("_place") + F.lit(1)))
    return placed.withColumn("ruleid", ruleid).drop("_decoded", "_time", "_place")


def rule_rows(matched: DataFrame) -> DataFrame:
    """The flow itself, and a copy tagged ``flowlogrule`` for one that hit a rule."""
    tag = "struct<es_type:string,es_index:string,ruleid:string>"
    plain = F.struct("es_type", "es_index", F.lit(None).cast("string").alias("ruleid"))
    hit = F.struct(F.lit("flowlogrule"), F.lit("flowlogrule"), F.col("ruleid"))
    tags = F.when(F.col("ruleid").isNull(), F.array(plain.cast(tag))).otherwise(
        F.array(plain.cast(tag), hit.cast(tag))
    )
    kept = [c for c in matched.columns if c not in ("es_type", "es_index", "ruleid")]
    return matched.select(*kept, F.explode(tags).alias("_tag")).select(*kept, "_tag.*")
