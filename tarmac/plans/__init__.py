"""The reports."""

from tarmac.plans.reports import (
    delay_totals,
    departure_delay,
    flights_per_model,
    popular_types,
    top_models,
    top_types,
    type_counts,
)

__all__ = [
    "delay_totals",
    "departure_delay",
    "flights_per_model",
    "popular_types",
    "top_models",
    "top_types",
    "type_counts",
]
