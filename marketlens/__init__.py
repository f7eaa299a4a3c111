"""marketlens — e-commerce analytics as Spark DataFrame jobs.

Layout:
  sources/    schemas, readers, writers and the test-data adapter
  functions/  small Column-expression helpers (dates, money, ratios)
  operators/  distributed building blocks Spark lacks as one call
              (global rank / ntile / row number without a single-partition
              window, exact quantiles, skew-safe per-group sequence numbering)
  plans/      the analyses themselves: shop SQL pack, sales EDA, warehouse
              ETL, KPIs and report measures, report datasets
"""

from marketlens.sources.tables import Tables
from marketlens.session import get_session, ensure_checkpoint_dir

__all__ = ["Tables", "get_session", "ensure_checkpoint_dir"]
