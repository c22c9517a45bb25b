"""Text values of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a model text becomes a label.
NON_DIGITS = "[^0-9]+"
LABEL_LENGTH = 3
CESSNA_LABEL = "Cessna "


def model_label(model: Column, label: str = CESSNA_LABEL) -> Column:
    """``T210L`` becomes ``Cessna 210``: non-digits turn into single spaces, three characters stay.

    Labels with fewer than three characters are kept as they are.
    """
    digits = F.trim(F.regexp_replace(model, NON_DIGITS, " "))
    return F.concat(F.lit(label), F.substring(digits, 1, LABEL_LENGTH))


def aircraft_type(manufacturer: Column, model: Column) -> Column:
    """``manufacturer model``, null if either is."""
    return F.concat(manufacturer, F.lit(" "), model)


def tuple_line(*columns: Column) -> Column:
    """``(a,b,c)``, with ``null`` for missing values."""
    shown = [F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    return F.concat(F.lit("("), F.concat_ws(",", *shown), F.lit(")"))
