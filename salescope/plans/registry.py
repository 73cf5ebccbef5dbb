"""All registered queries."""

from salescope.plans import (  # noqa: F401
    queries_cleaning,
    queries_drift,
    queries_extra,
    queries_files,
    queries_grouped,
    queries_models,
    queries_profile,
    queries_properties,
    queries_series,
)
from salescope.plans.catalog import ENTRIES

__all__ = ["ENTRIES"]
