"""parcelle — property-sale analytics as Spark DataFrame / MLlib jobs.

Sub-packages
------------
sources     scans, fixtures, sinks, model persistence, link extraction
functions   column expressions (projection, null-safe sums, hash uniforms)
operators   cleaning, roll-up, spatial joins, kNN, encoders, anomaly filter,
            splits, evaluation
models      elastic net, boosted trees, GAM, combined / stacked, search, Shapley
plans       the end-to-end jobs and the query registry used by the driver
streaming   incremental file landing (file source, availableNow)
"""

from parcelle.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
