"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Rounds halve the paths to a root at least; so many rounds do for 2**60 vertices on a path.
MOST_ROUNDS = 60


def connected_components(links: DataFrame, stored: bool = False) -> DataFrame:
    """(id, component) of every vertex of links(a, b); component is the smallest id that links reach.

    Every vertex points at the smallest vertex known to be in its component. In a round,
    each link moves to the roots of its ends, the greater root then points at the smallest
    root next to it, and these pointers are followed twice. A link whose ends have one root goes.
    stored says that links are read from a table, so that they need not be written first.
    All steps are joins and partial aggregates on ids, so that a vertex with very many
    links is summed up where its links lie; each round is written to the shared folder.

    Defined results: links from a vertex to itself, repeated links and links with a null
    end are ignored (the first kind keeps its vertex); without links there are no rows.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null")
    if not stored:
        links = written(links, "links")
    roots = written(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("root", F.col("id")), "roots")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    for _ in range(MOST_ROUNDS):
        # the smallest root beside each root
        hooks = written(edges.groupBy("high").agg(F.min("low").alias("low")), "hooks")
        if hooks.isEmpty():
            return _settled(roots)
        hooks = written(_followed(_followed(hooks, "high", "low"), "high", "low"), "hooks")
        moved = roots.join(hooks.select(F.col("high").alias("root"), F.col("low").alias("lower")), "root", "left")
        roots = written(moved.select("id", F.coalesce("lower", "root").alias("root")), "roots")
        left = hooks.select(F.col("high").alias("low"), F.col("low").alias("low_to"))
        right = hooks.select("high", F.col("low").alias("high_to"))
        both = edges.join(left, "low", "left").join(right, "high", "left").select(F.coalesce("high_to", "high").alias("x"), F.coalesce("low_to", "low").alias("y"))
        edges = written(both.where("x <> y").select(F.greatest("x", "y").alias("high"), F.least("x", "y").alias("low")).distinct(), "edges")
    raise RuntimeError("components did not settle")


def _followed(pointers: DataFrame, of: str, to: str) -> DataFrame:
    """Each pointer replaced by the one that its target has."""
    via = pointers.select(F.col(of).alias("__via"), F.col(to).alias("__next"))
    return pointers.join(via, F.col(to) == F.col("__via"), "left").select(of, F.coalesce("__next", to).alias(to))


def _settled(roots: DataFrame) -> DataFrame:
    """Pointers followed to their ends; a root that was hooked while others pointed at it has its own row."""
    for _ in range(MOST_ROUNDS):
        via = roots.where("id <> root").select(F.col("id").alias("__via"), F.col("root").alias("__next"))
        step = roots.join(via, F.col("root") == F.col("__via"), "left")
        if step.where("__next is not null").isEmpty():
            return roots.select("id", F.col("root").alias("component"))
        roots = written(step.select("id", F.coalesce("__next", "root").alias("root")), "roots")
    raise RuntimeError("pointers did not settle")
