"""featurewright: feature, label, scoring and monitoring pipelines on Spark.

Subpackages:
  functions  native column expressions (time, bucketing, flags)
  sources    readers, writers and the test-table stand-ins
  operators  reusable DataFrame operators (windows, as-of join, scans, prep, metrics, history)
  plans      table-level composites (trip features, customer features, monitoring, training)
  streaming  Structured Streaming versions of the feature and scoring jobs
"""

__version__ = "0.1.0"
