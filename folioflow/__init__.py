"""folioflow - daily index-portfolio feeds on Spark.

Landed JSON response pages are flattened, cleaned and parsed with native
Column expressions, written as daily-partitioned Parquet, aggregated by
asset and checked - every step a DataFrame transformation.
"""

from folioflow.options import JobOptions
from folioflow.session import build_session, scratch_path, shared_dir

__version__ = "0.1.0"

__all__ = ["JobOptions", "build_session", "scratch_path", "shared_dir", "__version__"]
