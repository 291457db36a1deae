"""shelfcast — retail inventory analytics on Spark.

Every output table is a plain function ``DataFrame(s) + Params -> DataFrame``;
the write layer (partitioned Parquet, dynamic partition overwrite) lives in
``shelfcast.sources.store``.
"""

from shelfcast.params import Params

__all__ = ["Params"]
