from featurewright.streaming.features import (  # noqa: F401
    fresh_paths,
    run_feature_stream,
    run_scoring_stream,
    stream_dropoff_features,
    stream_pickup_features,
    stream_source,
)
