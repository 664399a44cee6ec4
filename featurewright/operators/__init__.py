"""Reusable DataFrame operators (see README for the SURVEY id of each)."""

from featurewright.operators.asof import Lookup, asof_lookup, training_set  # noqa: F401
from featurewright.operators.history import (  # noqa: F401
    champion_history,
    latest_version,
    rekey,
    run_snapshot,
    scd2_merge,
    stack,
    stack_by_name,
    upsert,
)
from featurewright.operators.joins import assemble, events_between, events_until, rows_for_keys  # noqa: F401
from featurewright.operators.metrics import (  # noqa: F401
    check_thresholds,
    classification_metrics,
    compare_metrics,
    confusion_matrix,
    evaluate_regression,
    regression_metrics,
    roc_auc,
    roc_auc_ovr,
)
from featurewright.operators.prep import PrepConfig, Preprocessor, downsample, fill_zero, min_max, split  # noqa: F401
from featurewright.operators.scan import prefix_sums, row_index, surrogate_id  # noqa: F401
from featurewright.operators.windows import filter_by_ts, sliding, tumbling  # noqa: F401
