"""The three relations: which columns they have and where a CSV line holds them.

Every column is text. Operators refer to columns by these names only, so a parquet
table with the same names works as well as the CSV files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def columns_from_mask(mask: str, names: list[str]) -> dict[int, str]:
    """Pair each ``1`` of a column mask with a name: ``("101", ["a", "b"])`` gives ``{0: "a", 2: "b"}``."""
    positions = [i for i, flag in enumerate(mask) if flag == "1"]
    if set(mask) - {"0", "1"} or len(positions) != len(names):
        raise ValueError(f"mask {mask!r} does not select {len(names)} columns")
    return dict(zip(positions, names))


@dataclass(frozen=True)
class Relation:
    name: str
    positions: dict[int, str]

    @property
    def columns(self) -> list[str]:
        return list(self.positions.values())

    def schema(self, columns: list[str] | None = None) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in columns or self.columns])

    def position_of(self, columns: list[str] | None = None) -> dict[str, int]:
        """0-based CSV position of each wanted column."""
        where = {name: i for i, name in self.positions.items()}
        return {c: where[c] for c in columns or self.columns}


# The column masks of the published on-time-performance CSV files.
FLIGHTS = Relation(
    "flights",
    columns_from_mask(
        "0101001101",
        ["carrier_code", "flight_date", "tail_number", "scheduled_departure", "actual_departure"],
    ),
)
AIRCRAFTS = Relation("aircrafts", columns_from_mask("10101", ["tail_number", "manufacturer", "model"]))
AIRLINES = Relation("airlines", columns_from_mask("111", ["carrier_code", "name", "country"]))

RELATIONS = {r.name: r for r in (FLIGHTS, AIRCRAFTS, AIRLINES)}
