"""All registered queries: importing this module fills the registry."""

from veritab.plans import (  # noqa: F401
    catalog_drift,
    catalog_features,
    catalog_history,
    catalog_jobs,
    catalog_missing,
    catalog_ml,
    catalog_profile,
    catalog_quality,
    catalog_sampling,
    catalog_streaming,
)
from veritab.plans.registry import ORACLES, QUERIES  # noqa: F401
