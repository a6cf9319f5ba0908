"""Column expressions and fixed code maps."""

from tierline.functions.codes import UNKNOWN
from tierline.functions.expressions import (
    bad_int_date, day_before, has_outer_spaces, int_to_date, map_code, normalized, remainder_from,
    strip_prefix)

__all__ = ["UNKNOWN", "bad_int_date", "day_before", "has_outer_spaces", "int_to_date", "map_code",
           "normalized", "remainder_from", "strip_prefix"]
