"""Location enrichment: standard names, state codes, flags and city tiers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States and their codes, union territories, capitals and city tiers.
STATE_CODES = {
    "Delhi": "DL", "Maharashtra": "MH", "Uttar Pradesh": "UP", "Gujarat": "GJ", "Rajasthan": "RJ",
    "Kerala": "KL", "Punjab": "PB", "Karnataka": "KA", "Madhya Pradesh": "MP", "Odisha": "OR",
    "Chandigarh": "CH", "West Bengal": "WB", "Sikkim": "SK", "Andhra Pradesh": "AP", "Assam": "AS",
    "Jammu and Kashmir": "JK", "Puducherry": "PY", "Uttarakhand": "UK", "Himachal Pradesh": "HP",
    "Tamil Nadu": "TN", "Goa": "GA", "Telangana": "TG", "Chhattisgarh": "CG", "Jharkhand": "JH",
    "Bihar": "BR",
}
STATE_NAMES = {"Delhi": "New Delhi"}
UNION_TERRITORIES = ["Delhi", "Chandigarh", "Puducherry", "Jammu and Kashmir"]
CAPITALS = {"Delhi": "New Delhi", "Maharashtra": "Mumbai"}
TIER_1 = ["Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Pune", "Ahmedabad"]
TIER_2 = [
    "Jaipur", "Lucknow", "Kanpur", "Nagpur", "Indore", "Bhopal", "Patna", "Vadodara", "Coimbatore",
    "Ludhiana", "Agra", "Nashik", "Ranchi", "Meerut", "Raipur", "Guwahati", "Chandigarh",
]
LAST_TIER = "Tier-3"


@dataclass(frozen=True)
class LocationRules:
    """The rule tables; all are a few dozen entries and become literals in the plan."""

    state_names: dict[str, str] = field(default_factory=lambda: STATE_NAMES)
    state_codes: dict[str, str] = field(default_factory=lambda: STATE_CODES)
    union_territories: list[str] = field(default_factory=lambda: UNION_TERRITORIES)
    capitals: dict[str, str] = field(default_factory=lambda: CAPITALS)
    tiers: dict[str, list[str]] = field(default_factory=lambda: {"Tier-1": TIER_1, "Tier-2": TIER_2})


def _texts(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)


def look_up(c: str, table: dict[str, str]) -> Column:
    """Value for the text in column ``c``, NULL when it is not listed."""
    listed = f"map_from_arrays(array({_texts(table)}), array({_texts(table.values())}))"
    return F.expr(f"try_element_at({listed}, `{c}`)")


def listed(c: str, values: list[str]) -> Column:
    """Whether the text in column ``c`` is in a list; false for NULL."""
    return F.expr(f"coalesce(`{c}` IN ({_texts(values)}), false)")


def location_columns(state: str, city: str, rules: LocationRules = LocationRules()) -> dict[str, Column]:
    """Derived location columns; all rules look at the state as it was landed."""
    tier = F.coalesce(
        *[F.when(listed(city, cities), name) for name, cities in rules.tiers.items()], F.lit(LAST_TIER)
    )
    return {
        "state": F.coalesce(look_up(state, rules.state_names), F.col(state)),
        "state_code": look_up(state, rules.state_codes),
        "is_union_territory": listed(state, rules.union_territories),
        "capital_city_flag": F.coalesce(look_up(state, rules.capitals) == F.col(city), F.lit(False)),
        "city_tier": tier,
    }


def enrich_location(df: DataFrame, rules: LocationRules = LocationRules()) -> DataFrame:
    """Add the derived columns to a table with ``state`` and ``city``."""
    return df.withColumns(location_columns("state", "city", rules))
