"""Rules by the time at which they were valid."""

import pytest
from pyspark.sql import functions as F

from flowvigil.operators.rule_versions import RuleFeed, dated_rules
from flowvigil.operators.rules import Rule, match_rules
from flowvigil.sources.tables import rows

VERSIONS = "ruleid string, rule_pos int, valid_from bigint, sourceip string, destip string, rule_regular_expression string"
FLOWS = "uri string, srcip string, dstip string, date bigint"


def versions(spark, *values):
    full = [(name, pos, since, "any", "any", pattern) for name, pos, since, pattern in values]
    return dated_rules(rows(spark, full, VERSIONS))


def test_a_version_holds_up_to_the_next(spark):
    dated = versions(spark, ("a", 1, 10, "one"), ("a", 1, 20, "two"), ("a", 1, 30, None), ("a", 1, 40, "one"), ("b", 2, None, "o"))
    found = {(r.ruleid, r.valid_from, r.valid_to, r.rule_regular_expression) for r in dated.collect()}
    assert found == {("a", 10, 20, "one"), ("a", 20, 30, "two"), ("a", 40, None, "one"), ("b", None, None, "o")}


def test_versions_with_one_start(spark):
    dated = versions(spark, ("a", 1, 10, "one"), ("a", 2, 10, "two"), ("n", 1, None, "x"), ("n", 2, None, "y"))
    found = {(r.ruleid, r.rule_pos, r.valid_from, r.valid_to) for r in dated.collect()}
    assert found == {("a", 2, 10, None), ("n", 2, None, None)}


@pytest.mark.parametrize("index_from", [0, 1000])
def test_flows_meet_the_rules_of_their_time(spark, index_from):
    table = versions(
        spark, ("a", 1, 10, "onetwo"), ("a", 1, 20, "three"), ("a", 1, 30, None), ("b", 2, None, "[a-z]{3}"), ("b", 2, 25, None)
    )
    flows = rows(spark, [(uri, "s", "d", at) for at in (9, 10, 19, 20, 24, 25, 29, 30, None) for uri in ("/onetwo", "/three")], FLOWS)
    matched = match_rules(flows, table, index_from=index_from)
    assert "_time" not in matched.columns
    got = {(r.uri, r.date): r.ruleid for r in matched.collect()}
    for at in (9, 10, 19, 20, 24, 25, 29, 30, None):
        for uri in ("/onetwo", "/three"):
            a = at is not None and (10 <= at < 20 and uri == "/onetwo" or 20 <= at < 30 and uri == "/three")
            b = at is not None and at < 25
            assert got[uri, at] == ("a" if a else "b" if b else None), (uri, at)


def test_another_time_and_no_join(spark):
    flows = rows(spark, [("/abc", "s", "d", 0)], FLOWS).withColumn("seen", F.lit(15))
    rule = [Rule("r", "any", "any", "abc", since=10, until=20)]
    assert match_rules(flows, rule).first().ruleid is None
    matched = match_rules(flows, rule, time=F.col("seen"))
    assert matched.first().ruleid == "r"
    assert "Join" not in matched._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table_of_versions(spark):
    flows = rows(spark, [("/abc", "s", "d", 0)], FLOWS)
    assert match_rules(flows, versions(spark)).first().ruleid is None


def test_a_feed_takes_up_what_changed(spark):
    tables = [versions(spark, ("a", 1, 10, "one")), versions(spark, ("a", 1, 10, "one"), ("b", 2, 5, "item("), ("c", 3, 7, "x"))]
    calls = iter([tables[0], tables[0], tables[1]])
    feed = RuleFeed(lambda: next(calls))
    first = feed()
    assert first == feed() == [Rule("a", "any", "any", "one", 10, None)]
    assert [rule.ruleid for rule in feed()] == ["a", "c"]
