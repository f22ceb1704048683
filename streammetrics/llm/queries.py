"""All registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from streammetrics.llm import (bestfit, decontaminate, infill, language_id, licenses, packing, pii, quality, secrets, simhash,
                               spelling, topk, toxicity)

_MODULES = (topk, decontaminate, language_id, secrets, simhash, packing, toxicity, licenses, pii, quality, bestfit,
            infill, spelling)

LLM_QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
LLM_ORACLE_SQL = {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
