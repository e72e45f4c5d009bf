"""Connected components by rounds of joins: every vertex ends with the smallest vertex that it can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(vertex, root) for the vertices of ``edges`` (a, b). Links and labels stay distributed; what a round makes are written tables.

    In a round each vertex of the links takes its smallest neighbour, if that is smaller, and is replaced by what it reaches on this way. What remains of the
    links joins different ones of these, so the links of a star are read by one round only, whatever the number of rounds.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    ends = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = scratch.keep(edges.select(*ends).distinct(), "links")
    roots: DataFrame | None = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        tops = scratch.keep(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("vertex"), F.least("a", "b").alias("root")), "tops")
        while True:
            twice = _through(tops.withColumn("old", F.col("root")), tops)
            found = scratch.keep(_through(twice, twice), "tops")
            scratch.drop(tops)
            tops = found
            if tops.filter("root <> old").isEmpty():
                break
        after = tops if roots is None else scratch.keep(_through(roots, tops), "roots")
        top = tops.select(F.col("vertex").alias("a"), F.col("root").alias("x"))
        joined = links.join(top, "a").join(top.toDF("b", "y"), "b").filter("x <> y")
        left = scratch.keep(joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        scratch.drop(links, *([] if roots is None else [roots, tops]))
        links, roots = left, after
        if links.isEmpty():
            scratch.drop(links)
            return roots.select("vertex", "root")


def _through(roots: DataFrame, tops: DataFrame) -> DataFrame:
    """``roots`` with each root replaced by its own; one that has none stays."""
    up = tops.select(F.col("vertex").alias("root"), F.col("root").alias("top"))
    others = [c for c in roots.columns if c not in ("vertex", "root")]
    return roots.join(up, "root", "left").select("vertex", F.coalesce("top", "root").alias("root"), *others)
