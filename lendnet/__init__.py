"""lendnet: Spark-native credit-network analytics.

Every public operator is a plain function ``DataFrame -> DataFrame`` (usable with
``df.transform``) built from the DataFrame / SQL API, so Catalyst plans the joins,
aggregations and scans. Iterative graph jobs cut lineage with reliable checkpoints
into the folder named by ``spark.checkpoint.dir``.
"""

from lendnet.session import get_session, ensure_checkpoint_dir, cut_lineage

__all__ = ["get_session", "ensure_checkpoint_dir", "cut_lineage"]
