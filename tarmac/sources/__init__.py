"""Reading the relations."""

from tarmac.sources.relations import read_parquet, read_relation
from tarmac.sources.star import Star, read_star

__all__ = ["Star", "read_parquet", "read_relation", "read_star"]
