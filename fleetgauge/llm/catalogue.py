"""All queries of this subpackage."""

from . import conversation_queries, dedup_queries, langid_queries, rearrange_queries, screen_queries, search_queries, storage_queries, token_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
