"""Composite jobs: raw (bronze) and refined (silver) layers of a feed."""

from tierkit.plans.feeds import DimensionFeed, FactFeed
from tierkit.plans.jobs import (
    LakePaths,
    bronze_dimension,
    bronze_dimension_stream,
    bronze_fact,
    bronze_fact_stream,
    full_run,
    silver_dimension,
    silver_fact,
    silver_fact_unseen,
    unseen_captures,
)

__all__ = [
    "DimensionFeed",
    "FactFeed",
    "LakePaths",
    "bronze_dimension",
    "bronze_dimension_stream",
    "bronze_fact",
    "bronze_fact_stream",
    "full_run",
    "silver_dimension",
    "silver_fact",
    "silver_fact_unseen",
    "unseen_captures",
]
