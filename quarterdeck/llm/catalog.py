"""All queries of this package and their SQL."""

from __future__ import annotations

from quarterdeck.llm import (  # noqa: F401
    classifier_queries, collocation_queries, join_queries, merkle_queries, near_queries, pii_queries,
    secret_queries, token_queries, vector_queries)
from quarterdeck.llm.common import ORACLES, QUERIES  # noqa: F401
