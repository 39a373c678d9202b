"""All queries of the library by name, and the SQL that each must agree with."""

from __future__ import annotations

from .plans import citations, corpus, dedup, enrich, extra, html, preflight, roundtrip, runs, scoring, services, text

_ALL = (scoring, dedup, text, html, enrich, corpus, preflight, runs, services, roundtrip, citations, extra)
QUERIES = {name: q for m in _ALL for name, q in m.CATALOG.queries.items()}
ORACLES = {name: q for m in _ALL for name, q in m.CATALOG.oracles.items()}
