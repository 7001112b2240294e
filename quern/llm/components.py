"""Connected components by randomised contraction.

Each round every node picks the neighbour (or itself) with the smallest digest under the
round's salt; edges move to the picks, loops and doubles go, and what is left is
contracted again until no edge is left. A round lowers the number of nodes by a constant
share in expectation, whatever the shape: long paths and huge stars alike. The picks
of all rounds composed are the representatives. All of it is joins and aggregates
with partial sums; rounds are cut by tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.scratch import release, stored


def representatives(edges: DataFrame) -> DataFrame:
    """edges: (a, b). Gives (node, rep) for every node that has an edge; nodes are alike if and only if connected."""
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    picks: list[DataFrame] = []
    while not left.isEmpty():
        salt = F.lit(len(picks))
        both = left.union(left.select("b", "a"))
        digest = lambda c: F.struct(F.xxhash64(F.col(c), salt), F.col(c))  # noqa: E731, B023
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min(digest("b")).alias("n")).select("node", F.least(F.struct(F.xxhash64("node", salt).alias("h"), F.col("node").alias("v")), F.struct(F.col("n.col1").alias("h"), F.col("n.b").alias("v")))["v"].alias("pick"))
        pick = stored(nearest, "picks")
        moved = left.join(pick.toDF("a", "pa"), "a").join(pick.toDF("b", "pb"), "b").where("pa <> pb")
        rest = stored(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        release(left)
        left = rest
        picks.append(pick)
    if not picks:
        return left.select(F.col("a").alias("node"), F.col("b").alias("rep"))
    reps = picks[0].select("node", F.col("pick").alias("rep"))
    for pick in picks[1:]:
        reps = reps.join(pick.toDF("at", "next"), F.col("rep") == F.col("at"), "left").select("node", F.coalesce("next", "rep").alias("rep"))
    return reps
