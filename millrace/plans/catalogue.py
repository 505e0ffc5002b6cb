"""The registered queries of the curation operators, and their SQL."""

from __future__ import annotations

from millrace.plans import corpora, curation, events, modelled, records, style  # noqa: F401  registers its queries

QUERIES: dict = {**records.QUERIES}
ORACLES: dict = {**records.ORACLES}
