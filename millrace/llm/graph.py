"""Connected components of an edge table, in linear-size rounds: the library's own routine."""

from __future__ import annotations

from millrace.operators.components import connected_components

__all__ = ["connected_components"]
