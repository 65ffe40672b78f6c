"""Connected components of a graph given as a table of links."""

from pyspark.sql import functions as F

from txlens.staging import stage


def _star(edges, both_ways):
    """Tie the neighbours of every node to the least of them (and the node, if smaller).

    ``edges`` holds ``node > low``. ``both_ways`` looks at all neighbours of a node and ties the
    larger ones; otherwise at the smaller ones only. ``edges`` is a written table and the least
    ones are written before they are joined, so a node of many edges is split between tasks.
    """
    if both_ways:
        sides = edges.select(F.col("low").alias("node"), F.col("node").alias("near")).union(
            edges.select("node", F.col("low").alias("near")))
        least = stage(sides.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least")))
        tied = (sides.where("near > node").join(least, "node")
                .select(F.col("near").alias("node"), F.col("least").alias("low")))
    else:
        least = stage(edges.groupBy("node").agg(F.min("low").alias("least")))
        tied = (edges.join(least, "node").where("low > least")
                .select(F.col("low").alias("node"), F.col("least").alias("low"))
                .union(least.select("node", F.col("least").alias("low"))))
    return tied.where("node > low").distinct()


def components(links, left, right):
    """``(node, root)`` for every node with a link; the root is the component's least node.

    Alternates the two star steps, which take a logarithmic number of rounds; each round is a
    written table, so nothing but its size and checksum reaches the driver. Self links, repeated
    links and either direction are allowed; null ends are ignored.
    """
    edges = stage(links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("low"))
                  .where(F.col(left).isNotNull() & F.col(right).isNotNull())
                  .where("node > low").distinct())
    before = None
    while True:
        edges = stage(_star(stage(_star(edges, True)), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return edges.select("node", F.col("low").alias("root")).union(roots)
