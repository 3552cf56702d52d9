"""Every registered query, grouped as the operators are."""

from tellerlake.plans.queries import (  # noqa: F401
    cleansing,
    dashboard,
    dimensions,
    gold,
    masking,
    quality,
    runs,
    sinks,
    sources,
    statistics,
)
