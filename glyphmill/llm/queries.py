"""The operators' queries and the SQL of those that SQL can express."""

from __future__ import annotations

from glyphmill.llm import decontaminate, langid, lloyd, media, minhash, packing, passages, permutation, secrets, suffix, toxicity, urlfilter, variants

_MODULES = (toxicity, urlfilter, secrets, decontaminate, minhash, suffix, passages, packing, permutation, langid, variants, media, lloyd)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
