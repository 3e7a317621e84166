"""Import every query module so the registry is complete."""

from dayflow.plans import (  # noqa: F401
    feature_queries, flow_queries, model_queries, panel_queries, scale_queries, source_queries,
)
from dayflow.plans.registry import ORACLE, QUERIES  # noqa: F401
