"""tablefit: raw table to scored predictions as Spark DataFrame jobs.

Sub-packages
------------
sources    layered tables (bronze / silver / gold), IDs, reads and writes
functions  column expressions: metrics, densities, grids, scaler
operators  checks, splits, estimators, search, selection, scoring, calibration
plans      end-to-end flows and the registered query catalogue
streaming  the scoring projection applied to a streaming DataFrame
"""

from tablefit.spec import FeatureSpec, LINEITEM_SPEC

__all__ = ["FeatureSpec", "LINEITEM_SPEC"]
