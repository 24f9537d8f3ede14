"""Rules filed by literals, beside rules tried one by one."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowvigil.functions.lookup import HashedTable
from flowvigil.operators.rule_index import required_literal
from flowvigil.operators.rules import Rule, match_rules


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [
        (r"union\s+select", "select"),
        (r"/item\?id=12&", "/item?id=12&"),
        (r"(?:passwd){2,3}x?", "passwd"),
        (r"(etc/shadow)?root", "root"),
        (r"or|and", None),
        (r"a.b.c", None),
        (r"\Qa+b\E123", None),
        (r"(?i)SELECT", None),
        (r"abc(?=def)", "abc"),
        (r"item(", None),
        (r"x\101yz", None),
        ("", None),
        (r"(foo|bar)bazqux[0-9]*", "bazqux"),
        (r"ab*cdef", "cdef"),
    ],
)
def test_required_literal(pattern, literal):
    assert required_literal(pattern) == literal


_ATOM = st.sampled_from(["abc", "de", "f", "[0-9]", ".", r"\d+", "(gh|i)", "(jkl)?", "(mno)+", "^", "$", "x{2,3}"])


@settings(max_examples=300, deadline=None)
@given(st.lists(_ATOM, min_size=1, max_size=5), st.text("abcdefghijklmnox0123", max_size=30))
def test_every_match_holds_the_literal(atoms, text):
    pattern = "".join(atoms)
    literal = required_literal(pattern)
    if literal is not None and re.search(pattern, text):
        assert literal in text


def test_index_gives_what_one_by_one_gives(spark):
    uris = ["/a?id=1 UNION  select x", "/login", "/x?y=%2e%2e/etc/passwd", "/q?a,b", "", None, "/b?id=17&name=foo", "ü?ñandú=1"]
    rows = [(uri, f"10.0.0.{k % 3}", "10.0.1.1") for k, uri in enumerate(uris)]
    flows = spark.createDataFrame(rows, "uri string, srcip string, dstip string")
    rules = [
        Rule("ip", "10.0.0.2", "any", "passwd"), Rule("other", "any", "9.9.9.9", "login"), Rule("union", "any", "any", r"union\s+select"),
        Rule("late", "any", "any", "id="), Rule("comma", "any", "any", "[?].*,"), Rule("dots", "any", "any", r"\.\./etc"),
        Rule("name", "any", "any", r"id=1\d&name"), Rule("quote", "any", "any", "it's \\\\ \"x\""), Rule("word", "any", "any", "ñandú"),
        Rule("empty", "any", "any", "^$"),
    ]
    answers = []
    for index_from in (0, 1000):
        matched = match_rules(flows, rules, ip_match="strict", index_from=index_from)
        answers.append({row.uri: row.ruleid for row in matched.collect()})
    assert answers[0] == answers[1]
    assert answers[0] == {
        uris[0]: "union", "/login": None, uris[2]: "ip", "/q?a,b": "comma", "": "empty", None: None, uris[6]: "late", uris[7]: "word",
    }
    assert match_rules(flows, [], index_from=0).where("ruleid is not null").count() == 0


def test_index_moves_no_rows(spark):
    flows = spark.createDataFrame([("/a", "1", "2")], "uri string, srcip string, dstip string")
    rules = [Rule(f"r{k}", "any", "any", f"number={k}&") for k in range(500)]
    plan = match_rules(flows, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_hashed_table(spark):
    rows = [{"word": f"w{k % 70}", "n": k} for k in range(100)]
    table = HashedTable("word:string,n:int", rows, "word")
    keys = spark.createDataFrame([("w3",), ("w69",), ("nothing",), ("",)], "k string")
    found = {row.k: sorted(entry.n for entry in row.f) for row in keys.select("k", table.rows_of(F.col("k")).alias("f")).collect()}
    assert found == {"w3": [3, 73], "w69": [69], "nothing": [], "": []}
