"""Connected components of a link table by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import salted_join, saved


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every end of the links ``a``, ``b``.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest path. Hot nodes are salted; the state of each
    round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = saved(both, label)
    state = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), label)
    while True:
        near = (
            salted_join(both, state.select(F.col("node").alias("a"), "root"), ["a"], F.col("b"), salts=16)
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        low = state.join(near, "node").select("node", F.col("root").alias("former"), F.least("root", "near").alias("root"))
        low = saved(low, label)
        ahead = low.select(F.col("node").alias("root"), F.col("root").alias("jump"))
        jumped = salted_join(low, ahead, ["root"], F.col("node"), salts=16).select("node", "former", F.col("jump").alias("root"))
        jumped = saved(jumped, label)
        state = jumped.select("node", "root")
        if jumped.where(F.col("former") != F.col("root")).isEmpty():
            return state
