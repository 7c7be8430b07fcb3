"""Connected components of an undirected graph held as a table of links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.runtime import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): of every node that has a link to another, the least node it can reach. links: (a, b).

    Alternates two steps until the table of links stays as it is: every node links its larger neighbours to the
    least of its neighbours and itself, then every node links its smaller neighbours and itself to the least of them
    (Kiveris et al. 2014). Both keep components whole; what is left are stars around their least nodes. A node's
    neighbours are never put into one row: the least of them is an aggregate, and each goes on as a row of its own.
    The least ones are a written table when they are joined, so that adaptive execution can split a node that a large
    part of all links name. Each round is written to the shared folder.
    """
    pairs = links.select("a", "b").filter("a <> b")
    now = materialize(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "links")
        discard(least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        after = materialize(small.filter("u <> v").distinct(), "links")
        left = now.join(after, ["u", "v"], "left_anti").limit(1).count() + after.join(now, ["u", "v"], "left_anti").limit(1).count()
        discard(large, least, now)
        now = after
        if not left:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
