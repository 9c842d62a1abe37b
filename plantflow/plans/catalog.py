"""All registered queries."""

from plantflow.plans import (  # noqa: F401
    catalog_anchors,
    catalog_cleaning,
    catalog_decisions,
    catalog_edges,
    catalog_evaluation,
    catalog_jobs,
    catalog_profile,
    catalog_shifts,
    catalog_text,
    catalog_windows,
)
from plantflow.plans.registry import QUERIES, SQL  # noqa: F401
