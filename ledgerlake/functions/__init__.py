from ledgerlake.functions.names import normalise_header
from ledgerlake.functions.numeric import (
    avg_2dp,
    cents,
    complete_flag,
    finite,
    finite_sql,
    from_cents,
    parse_double,
    pct,
    safe_bigint,
    size_class,
    sum_2dp,
    year_of,
)

__all__ = [
    "avg_2dp", "cents", "complete_flag", "finite", "finite_sql", "from_cents", "normalise_header",
    "parse_double", "pct", "safe_bigint", "size_class", "sum_2dp", "year_of",
]
