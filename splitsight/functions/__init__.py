from splitsight.functions.scalars import (
    bands,
    coerce_number,
    coerce_timestamp,
    hours,
    micros,
    minutes_between,
    ratio_or_zero,
    to_ntz,
)

__all__ = [
    "bands",
    "coerce_number",
    "coerce_timestamp",
    "hours",
    "micros",
    "minutes_between",
    "ratio_or_zero",
    "to_ntz",
]
