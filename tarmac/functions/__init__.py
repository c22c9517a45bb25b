"""Column expressions. All are built-in functions, so they stay in generated code."""

from tarmac.functions.texts import aircraft_type, model_label, tuple_line
from tarmac.functions.times import delay_minutes, seconds_of_day

__all__ = ["aircraft_type", "delay_minutes", "model_label", "seconds_of_day", "tuple_line"]
