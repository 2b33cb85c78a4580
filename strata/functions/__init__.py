from strata.functions.scalar import (  # noqa: F401
    any_changed,
    any_null,
    elapsed_seconds,
    floor_days,
    null_tokens,
    run_id,
    tolerant_number,
    tolerant_timestamp,
)
