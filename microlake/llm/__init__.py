"""Operators for large training corpora. QUERIES and ORACLE_SQL hold their queries; nothing outside imports this package
but the entry module, which can do without it."""

from . import decontam, filters, licenses, lines, lm, mixing, quality, search, secrets, simhash, tokens, topk, toxicity

_MODULES = (decontam, filters, licenses, lines, lm, mixing, quality, search, secrets, simhash, tokens, topk, toxicity)
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE_SQL = {k: q for m in _MODULES for k, q in getattr(m, "ORACLE", {}).items()}
