from tidemark.functions.exprs import (  # noqa: F401
    nan_to_null,
    parse_mixed_timestamp,
    pct,
    ratio,
)
