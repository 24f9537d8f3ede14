"""URI decoding, normalisation and tokens."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowvigil.functions.segments import WordCosts, segmented

# Models and rules are only comparable with exactly these patterns.
STRAY_PERCENT = r"%(?![0-9a-fA-F]{2})"
NORMALIZE_STEPS = (
    (r"[a-z]+\d+([a-z])*", "luancode"),
    (r"\d+[a-z]+\d*", "luancode"),
    (r"(luancode[a-z\d]*)+", "luancode"),
    (r"\d+", "luannumber"),
)
WORD_SEPARATORS = r"\s|\(|\)|\-|\d|\,|\;|\/|\?|\%|\||\."


def uri_decode(uri: Column) -> Column:
    """Percent-decode (a stray ``%`` stays itself, ``+`` is a blank), lower case."""
    return F.lower(F.url_decode(F.regexp_replace(uri, STRAY_PERCENT, "%25")))


def uri_normalize(decoded: Column) -> Column:
    """Replace mixed letter-digit runs and numbers by placeholders."""
    for pattern, placeholder in NORMALIZE_STEPS:
        decoded = F.regexp_replace(decoded, pattern, placeholder)
    return decoded


def uri_tokens(normalized: Column, lexicon: Sequence[str] | WordCosts = ()) -> Column:
    """Segment into tokens joined by ``|``.

    With the costs of words, runs of letters are cut into words of least cost.
    With a plain lexicon: its longest word first, then runs of letters and
    digits, then single characters. Blanks only separate.
    """
    if isinstance(lexicon, WordCosts):
        return segmented(normalized, lexicon)
    words = sorted(set(lexicon), key=lambda word: (-len(word), word))
    choices = [re.escape(word) for word in words] + ["[a-z0-9]+", r"[^\s]"]
    return F.array_join(
        F.regexp_extract_all(normalized, F.lit("(" + "|".join(choices) + ")"), F.lit(1)), "|"
    )


def clean_uri(uri: Column, lexicon: Sequence[str] | WordCosts = ()) -> Column:
    """Text the URI model is trained on and applied to."""
    return uri_tokens(uri_normalize(uri_decode(uri)), lexicon)


def uri_words(text: Column) -> Column:
    """Words of the model's tokeniser as an array (its twin as an expression)."""
    return F.filter(F.split(F.lower(text), WORD_SEPARATORS), lambda word: word != "")
