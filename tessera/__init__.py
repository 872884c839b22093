"""tessera: PySpark operators for token-bag similarity, distinct counting,
graph measures, community detection and clustering evaluation.

Every operator takes DataFrames and returns a lazy DataFrame; the heavy work
is Spark joins, aggregations and windows planned by Catalyst.
"""

from tessera.session import checkpoint_dir, cut_lineage, get_session

__all__ = ["checkpoint_dir", "cut_lineage", "get_session"]
