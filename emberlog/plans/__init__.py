"""All registered queries."""

from emberlog.plans import (  # noqa: F401
    drift_queries,
    experiment_queries,
    log_queries,
    model_queries,
    quality_queries,
    stream_queries,
)
from emberlog.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
