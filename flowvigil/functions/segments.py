"""Segmentation of words written together, by least cost over a word lattice.

Every run of small letters is cut into dictionary words so that the sum of their
costs is least; a word's cost is the negative logarithm of its share of a corpus,
in thousandths. A letter that no word takes costs as much as a word ten times
rarer than the rarest there can be. Of cuts with equal cost the one with fewer pieces is
taken, then the one with the longer last piece, and so on from the end.

The lattice is walked in one pass over the positions, as an expression: the best
way to a position is the least over the words that end there. Words are looked up
in constant time, so a text takes time in proportion to its length and to the
longest word.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions.lookup import HashedTable

#: Tokens of a text before runs of letters are cut.
_RUN_OR_CHARACTER = "([a-z]+|[a-z0-9]+|[^\\s])"


@dataclass(frozen=True)
class WordCosts:
    """Costs of words of at most ``longest`` letters, and of a letter outside of them."""

    costs: Mapping[str, int]
    unknown: int
    longest: int

    @staticmethod
    def of_counts(counts: Mapping[str, int]) -> WordCosts:
        total = sum(counts.values())
        costs = {word: math.floor(1000 * math.log(total / n)) for word, n in counts.items()}
        return WordCosts(costs, math.floor(1000 * math.log(10 * max(1, total))), max(map(len, counts), default=1))


def word_counts(words: DataFrame, column: str, least: int, longest: int, most_words: int) -> dict[str, int]:
    """How often the words of letters stand in a column of arrays; the most frequent ``most_words``.

    That is the bound of the dictionary, which becomes a constant of the plan.
    """
    counted = (
        words.select(F.explode(column).alias("word"))
        .where(F.regexp_like("word", F.lit(f"^[a-z]{{2,{longest}}}$")))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.col("n").desc(), "word")
        .limit(most_words)
    )
    return {row["word"]: row["n"] for row in counted.collect()}


def _cut(run: Column, table: HashedTable, words: WordCosts) -> Column:
    """The pieces of one run of letters, as an array."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("cost"), F.lit(0).alias("pieces"), F.lit(0).alias("start")
    )
    kind = "struct<cost:bigint,pieces:int,start:int>"

    def ends_at(ways: Column, position: Column) -> Column:
        """The best way to a position; ``ways[k]`` is the best one to position k."""
        sizes = F.sequence(F.lit(1), F.least(position, F.lit(words.longest)))

        def way(size: Column) -> Column:
            before = F.get(ways, position - size)
            known = F.get(table.rows_of(F.substring(run, position - size + 1, size)), F.lit(0))["cost"]
            cost = F.coalesce(known, F.when(size == 1, F.lit(words.unknown).cast("bigint")))
            return F.when(
                cost.isNotNull(),
                F.struct(
                    (before["cost"] + cost).alias("cost"), (before["pieces"] + 1).alias("pieces"),
                    (position - size).alias("start"),
                ).cast(kind),
            )

        return F.array_min(F.transform(sizes, way))

    positions = F.when(F.length(run) > 0, F.sequence(F.lit(1), F.length(run)))
    ways = F.aggregate(
        positions, F.array(start.cast(kind)), lambda done, at: F.concat(done, F.array(ends_at(done, at)))
    )
    # From the end back: where each piece begins.
    back = F.struct(F.length(run).alias("end"), F.array().cast("array<string>").alias("pieces"))

    def pieces_of(found: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            begin = F.get(found, state["end"])["start"]
            piece = F.substring(run, begin + F.lit(1), state["end"] - begin)
            return F.when(state["end"] <= 0, state).otherwise(
                F.struct(begin.alias("end"), F.concat(F.array(piece), state["pieces"]).alias("pieces"))
            )

        return F.aggregate(positions, back, step, lambda state: state["pieces"])

    # The ways are bound to a variable here: written out, every step back would compute them anew.
    return F.get(F.transform(F.array(ways), pieces_of), F.lit(0))


def segmented(normalized: Column, words: WordCosts) -> Column:
    """Segment into tokens joined by ``|``: words of the dictionary, other runs, single characters."""
    table = HashedTable(
        "word:string,cost:bigint", [{"word": word, "cost": cost} for word, cost in sorted(words.costs.items())], "word"
    )
    tokens = F.regexp_extract_all(normalized, F.lit(_RUN_OR_CHARACTER), F.lit(1))
    pieces = F.transform(
        tokens, lambda token: F.when(F.regexp_like(token, F.lit("^[a-z]+$")), _cut(token, table, words)).otherwise(F.array(token))
    )
    return F.array_join(F.flatten(pieces), "|")
