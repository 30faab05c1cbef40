"""dealspark — a PySpark-native CRM analytics library.

Layers: raw (all-string CSV) → clean (typed Parquet) → curated (feature and
report tables), plus profiling, data-quality checks and Spark ML lead scoring.
Every operator is a ``DataFrame → DataFrame`` function built from native
Spark expressions; actions happen only in ``plans`` (writes) and tests.
"""

__version__ = "0.1.0"
