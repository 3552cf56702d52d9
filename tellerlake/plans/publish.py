"""The lake as SQL views, seen through the masks of a role."""

from __future__ import annotations

from collections.abc import Iterable

from tellerlake.operators.masking import apply_masks
from tellerlake.operators.views import monthly_spend_profile, type_trend
from tellerlake.plans.daily import BUILT, LOADED
from tellerlake.sources.lake import Lake


def publish(lake: Lake, roles: Iterable[str] = ()) -> list[str]:
    """Register every table and both gold views as temporary views; return their names.

    The gold views are built over the masked tables, so a masked role sees zero
    totals and shortened names there too. Their join key is never masked.
    """
    roles = list(roles)
    names = [*LOADED, *BUILT, "silver/dim_date", "governance/data_quality_log"]
    seen = {}
    for name in names:
        table = name.split("/")[1]
        seen[table] = apply_masks(lake.read(name), table, roles)
    fact = seen["fact_daily_transaction"]
    seen["monthly_spend_profile"] = monthly_spend_profile(fact, seen["dim_customer"])
    seen["txn_type_trend"] = type_trend(fact)
    for table, df in seen.items():
        df.createOrReplaceTempView(table)
    return list(seen)
