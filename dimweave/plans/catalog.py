"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from . import q_audit, q_batch, q_dimension, q_io, q_origin  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
