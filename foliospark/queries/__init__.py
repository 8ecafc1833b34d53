"""Every query of the engine by name, and its oracle where SQL can express it."""

from foliospark.queries import built, ordered, pages, relations, site, texts
from foliospark.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "built", "ordered", "pages", "relations", "site", "texts"]
