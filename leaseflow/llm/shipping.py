"""Makes this package importable in Python workers that don't have it installed."""

from __future__ import annotations

from leaseflow.sources.shipping import ship

__all__ = ["ship"]
