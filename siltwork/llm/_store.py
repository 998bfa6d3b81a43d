"""Tables that cut lineage; see siltwork.store."""

from siltwork.store import shared, stage

__all__ = ["shared", "stage"]
