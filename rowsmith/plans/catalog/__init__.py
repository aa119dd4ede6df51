"""Queries over the driver's tables, one or more per operator."""

from rowsmith.plans.catalog import (  # noqa: F401
    aggregates,
    encoders,
    evaluation,
    jobs,
    missing,
    model_checks,
    preparation,
    projections,
    selection,
    sources,
    splits,
    texts,
)
from rowsmith.plans.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
