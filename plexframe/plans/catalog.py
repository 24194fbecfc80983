"""Registry of the engine's queries and of equivalent SQL."""

from __future__ import annotations

from plexframe.plans import oracle, proxies, slides

FLAGSHIP = "flagship_patch_coords"
QUERIES = {**proxies.QUERIES, **slides.QUERIES}
ORACLE_SQL = {**oracle.ORACLE_SQL, **slides.ORACLE_SQL}

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
