"""tessera: Spark-native text preparation, token packing and sparse-coding analytics.

Every operator is a function from DataFrame to DataFrame (or to a Column).
Nothing here materialises data on the driver except bounded parameter
tables (dictionaries whose size is checked, per-partition offsets).
"""

from tessera.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
