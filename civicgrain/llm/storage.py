"""Cutting lineage through the folder all executors share."""

from __future__ import annotations

from civicgrain.operators.tables import written as saved

__all__ = ["saved"]
