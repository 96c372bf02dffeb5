"""pitchlens: league and season analytics as plain Spark DataFrame functions.

Sub-packages:
  sources    landing JSON/CSV into typed tables, writing and reading models
  functions  column expressions (casts, labels, guarded ratios, pick scores)
  operators  keyed/ordered DataFrame operators (two-sided rows, rolling and
             look-ahead windows, latest-per-key, dimension joins)
  plans      the league models (staging, intermediate, marts) and the driver
             views that feed them
  streaming  incremental landing of new payload files with full-replace sinks
"""

from pitchlens.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
