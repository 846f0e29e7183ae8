"""Named queries over the standard tables, each with an equal SQL text where SQL can say it."""

from tidemill.plans import (  # noqa: F401
    charts,
    corpus,
    experiments,
    files,
    keyed,
    logs,
    objects,
    quality,
    runs,
    series,
    sessions,
    streams,
)
from tidemill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
