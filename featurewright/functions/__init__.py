from featurewright.functions.scalar import (  # noqa: F401
    BucketRange,
    as_int,
    bucket,
    bucket_sql,
    flag,
    json_map,
    match_any,
    squash_blanks,
    trunc_nullable_int,
)
from featurewright.functions.time import (  # noqa: F401
    as_date,
    as_ts,
    ceil_minutes,
    epoch_micros,
    from_epoch_micros,
    from_millis,
    is_weekend,
    plus_months,
    window_end,
    year_month,
)
