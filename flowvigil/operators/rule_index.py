"""Rules by the thousand: a flow tries the expressions whose literals it holds.

Most rule expressions need some literal text to match. The longest of it is taken
out of each, and the rule is filed under one of its trigrams, one that few other
rules have. A flow looks up the trigrams of its address, drops the rules whose
whole literal it does not hold, and runs the expressions that are left. Rules
without such a literal are tried one by one, as ``match_rules`` does for a few.

The index is a constant of the plan like the rules themselves: no join, no
shuffle, nothing stored. What a flow costs depends on its length and on the rules
that share literals with it, not on how many rules there are.
"""

from __future__ import annotations

import re
import re._constants as kinds
import re._parser as parser
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowvigil.functions.lookup import HashedTable

GRAM = 3

#: Spellings that the two dialects of expressions read differently: no literal is taken then.
_DOUBTFUL = re.compile(r"\\[0-9QEchpPXRGkN]|\(\?[^:=!<]|\(\?<[^=!]|&&|\(\?#")


def _literal_runs(parsed: parser.SubPattern) -> Iterator[str]:
    """Texts that stand in every match, each in one piece."""
    run = ""
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            run += chr(value)
            continue
        yield run
        run = ""
        if kind is kinds.SUBPATTERN:
            yield from _literal_runs(value[-1])
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0] > 0:
            yield from _literal_runs(value[2])
    yield run


def required_literal(pattern: str) -> str | None:
    """The longest text that every match of the expression holds, or None.

    Errs on the side of None: spellings that may mean something else to the
    engine that runs the expression are not looked into.
    """
    if _DOUBTFUL.search(pattern):
        return None
    try:
        runs = list(_literal_runs(parser.parse(pattern)))
    except (re.error, OverflowError, RecursionError):
        return None
    longest = max(runs, key=len, default="")
    return longest if len(longest) >= GRAM else None


def grams_of(literal: str) -> list[str]:
    return [literal[k : k + GRAM] for k in range(len(literal) - GRAM + 1)]


def text_grams(text: Column) -> Column:
    """The different trigrams of a text."""
    starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - F.lit(GRAM - 1)))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.coalesce(F.transform(starts, lambda k: F.substring(text, k, F.lit(GRAM))), none))


class RuleIndex:
    """Rules (``pattern``, ``since``, ``until``) in order of priority, filed by their literals.

    ``wanted`` gives the address a rule asks for, or None where it takes any.
    """

    def __init__(self, rules: Sequence, source: Callable, target: Callable) -> None:
        literals = [required_literal(rule.pattern) for rule in rules]
        shared = Counter(gram for literal in literals if literal for gram in set(grams_of(literal)))
        rows = []
        self.unfiled: list[int] = []
        for place, (rule, literal) in enumerate(zip(rules, literals, strict=True)):
            if literal is None:
                self.unfiled.append(place)
                continue
            gram = min(grams_of(literal), key=lambda one: (shared[one], one))
            rows.append(
                {
                    "gram": gram, "place": place, "literal": literal, "pattern": rule.pattern,
                    "source": source(rule), "target": target(rule),
                    "since": rule.since, "until": rule.until,
                }
            )
        self._table = HashedTable(
            "gram:string,place:int,literal:string,pattern:string,source:string,target:string,"
            "since:bigint,until:bigint",
            rows,
            "gram",
        )
        self.filed = len(rows)

    def first_place(
        self, text: Column, srcip: Column, dstip: Column, time: Column | None = None
    ) -> Column:
        """The place of the first filed rule that the text and the addresses hit, or null.

        With ``time`` only rules valid then are tried.
        """

        def valid(rule: Column) -> Column:
            if time is None:
                return F.lit(True)
            begun = rule["since"].isNull() | (time >= rule["since"])
            return begun & (rule["until"].isNull() | (time < rule["until"]))

        found = F.flatten(F.transform(text_grams(text), self._table.rows_of))
        hits = F.filter(
            found,
            lambda rule: valid(rule)
            & F.contains(text, rule["literal"])
            & (rule["source"].isNull() | (srcip == rule["source"]))
            & (rule["target"].isNull() | (dstip == rule["target"]))
            & F.regexp_like(text, rule["pattern"]),
        )
        return F.array_min(F.transform(hits, lambda rule: rule["place"]))
