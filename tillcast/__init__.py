"""tillcast — Spark-native retail demand analytics and forecasting.

Every operator takes and returns a ``pyspark.sql.DataFrame``; nothing is
collected to the driver.  Sub-packages:

* ``sources``   panel scans, star-schema binding, forecast sinks and checks
* ``functions`` NULL-safe scalar column helpers (clip, ratios, calendars)
* ``operators`` preparation, grain aggregates, lookups, windows, encoders,
                 feature layers, metrics, ensembles and MLlib learners
* ``plans``     composed forecasts, the model-free monthly plan, reports
"""

from tillcast.horizon import Horizon

__all__ = ["Horizon"]
