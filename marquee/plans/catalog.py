"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from marquee.plans import features, ingest, learning, offline, online, streams  # noqa: F401
from marquee.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
