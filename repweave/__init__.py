"""repweave: replicate-weight survey estimation on Spark DataFrames.

Layout
------
- ``sources``   readers for microdata, replicate weights, lookup tables, published cells
- ``functions`` Column-level recodes and scalar helpers (pure expressions)
- ``operators`` DataFrame operators: intervals, sufficient-statistics cube,
  estimators, regression, normalisers, checks
- ``plans``     end-to-end jobs (prepare, feature table) and the query registry
- ``streaming`` incremental weekly refresh
"""

from repweave.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
