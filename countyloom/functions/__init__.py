from countyloom.functions.columns import (  # noqa: F401
    count_where,
    distinct_where,
    full_match,
    has_text,
    missing_or_na,
    no_text,
    shown,
    sum_where,
    text_or_null,
    to_double,
    to_int,
    trimmed,
    trimmed_in,
)
