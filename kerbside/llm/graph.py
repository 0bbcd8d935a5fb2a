"""Connected components by random contraction, with nothing of the graph on the driver."""

from pyspark.sql import functions as F

from kerbside.session import stage


def components(edges, a="a", b="b"):
    """``node, root`` for every node of the undirected ``edges``; nodes of one component share their root.

    Each round orders the nodes at random and maps every node to the least of itself and its neighbours; edges then
    join what they were mapped to. A constant share of the nodes goes in a round whatever the shape of the graph, so
    rounds grow with the logarithm of the largest component. Every round is written to the shared folder. Null ends
    and loops are ignored; without edges the result is empty.
    """
    left = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    steps = []
    while not left.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(len(steps)), F.col(c))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("to"))).alias("m"))
        step = stage(least.select(F.col("a").alias("node"), F.when(F.col("m.r") < rank("a"), F.col("m.to")).otherwise(F.col("a")).alias("root")), "contract")
        steps.append(step)
        to = lambda end: step.select(F.col("node").alias(end), F.col("root").alias(f"{end}_to"))
        left = stage(left.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
                     .where("a <> b").distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        nearer = step.select(F.col("node").alias("root"), F.col("root").alias("further"))
        found = found.join(nearer, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return found
