"""Sunset engine: near-sunset air traffic, bird strikes and raster zonal means on Spark.

Every operator takes and returns a ``pyspark.sql.DataFrame``; column math lives in
``sunset_engine.functions`` as built-in ``Column`` expressions, so whole-stage
codegen covers it and no Python runs per row.
"""

from sunset_engine.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
