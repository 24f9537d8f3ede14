"""All queries of this package; importing it registers them."""

from flowvigil.llm import (  # noqa: F401
    queries_bench,
    queries_mixing,
    queries_models,
    queries_native,
    queries_nearest,
    queries_resample,
    queries_text,
    queries_trie,
)
from flowvigil.llm.registry import ORACLES, QUERIES  # noqa: F401
