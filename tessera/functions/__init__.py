"""Scalar functions (X1-X15) and their Arrow UDF twins (D-1, D-2)."""

from tessera.functions.expressions import (PART_OF_DAY_BANDS, PART_OF_DAY_REST,  # noqa: F401
                                           TEXT_TIMESTAMP_PATTERN, clock_text, explode_tokens,
                                           fixed_text,
                                           hhmm_to_hour, money_to_double, parse_timestamp,
                                           part_of_day, percent_of, rounded, safe_long,
                                           sorted_values, strip, times)
from tessera.functions.udfs import apply_times_udf, part_of_day_udf, times_udf  # noqa: F401
