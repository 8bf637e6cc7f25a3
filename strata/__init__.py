"""strata — reusable, parameterised PySpark operators for log analytics,
sampling, feature building, model fitting/tuning, recommendation,
clustering and distributed decompositions.

Every public operator takes and returns DataFrames and leaves the physical
plan to Catalyst; nothing unbounded is collected to the driver.
"""

__all__ = ["session"]
