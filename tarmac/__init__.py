"""On-time-performance analytics of air traffic, as Spark DataFrame operations."""

from tarmac.model import AIRCRAFTS, AIRLINES, FLIGHTS, Relation, columns_from_mask
from tarmac.plans import departure_delay, popular_types, top_models
from tarmac.sinks import tuple_lines, write_flights_by_year, write_tuple_text
from tarmac.sources import read_parquet, read_relation

__all__ = [
    "AIRCRAFTS",
    "AIRLINES",
    "FLIGHTS",
    "Relation",
    "columns_from_mask",
    "departure_delay",
    "popular_types",
    "read_parquet",
    "read_relation",
    "top_models",
    "tuple_lines",
    "write_flights_by_year",
    "write_tuple_text",
]
