"""All registered queries."""

from geoloom.plans import (  # noqa: F401
    element_queries,
    layer_queries,
    metric_queries,
    spatial_queries,
    tile_queries,
)
from geoloom.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
