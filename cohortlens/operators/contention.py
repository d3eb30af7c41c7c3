"""Exact picks of a major that is too large for one task, by clusters of rival groups.

Every group starts as a cluster of its own and takes its best option. Clusters
that take the same course merge, and only merged clusters are solved again, each
in a task; prices of courses come with the solution. In the end no course is taken
twice. That is optimal: a cluster's groups would not do better with any course at
its price within the cluster, all the more so where another cluster's price is
added, and every course with a price is taken (complementary slackness).

Equal plans are told apart afterwards. Another plan of the same value can only use
options that are worth their price to the group. Groups connected by such options
settle among themselves which plan is first; apart from them nothing moves.

So a task sees the groups that get in each other's way, directly or through
others, not the major. If all groups of a major want the same few courses, they
are one cluster.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import components, stage
from .choice import GROUP, SAME, Assignment, assign, first_of_best

FIELDS = "major string, choice_group_id {id}, course string, value double, place int, rank int, cluster {id}"
COLUMNS = [*GROUP, "course", "value", "place", "rank", "cluster"]


def _read(rows: pd.DataFrame) -> tuple[dict, dict, dict]:
    """Options offered to each group, their places, and the value of the first option left out."""
    options: dict[object, list[tuple[object, float]]] = {}
    places: dict[object, dict] = {}
    left_out: dict[object, float] = {}
    for g, course, value, place, rank, look in zip(
        rows["choice_group_id"], rows["course"], rows["value"], rows["place"], rows["rank"], rows["look"]
    ):
        if rank > look:
            left_out[g] = value
        else:
            options.setdefault(g, []).append((course, value))
            places.setdefault(g, {})[course] = place
    return options, places, left_out


def _solve_cluster(rows: pd.DataFrame) -> pd.DataFrame:
    """Picks of a cluster with prices and profits (`picked`), or its groups whose lists must grow
    (`short`), or one row that says it has no solution (`stuck`)."""
    rows = rows.sort_values(["choice_group_id", "rank"])
    options, _, left_out = _read(rows)
    found = assign(options)
    blank = {"price": 0.0, "profit": 0.0}
    if found.stuck:
        short = {g for g in found.stuck if g in left_out}
    else:
        # What is left out must be worth less, also for plans of equal value.
        short = {g for g, bound in left_out.items() if found.profit[g] <= bound + SAME}
    if short:
        marks = rows[rows["choice_group_id"].isin(short) & (rows["rank"] == 1)]
        return marks.assign(state="short", **blank)
    if found.stuck:
        return rows.head(1).assign(state="stuck", **blank)
    taken = [found.held[g] == c for g, c in zip(rows["choice_group_id"], rows["course"])]
    picked = rows[pd.Series(taken, index=rows.index) & (rows["rank"] <= rows["look"])]
    return picked.assign(
        state="picked", price=[found.price.get(c, 0.0) for c in picked["course"]],
        profit=[found.profit[g] for g in picked["choice_group_id"]],
    )


def _solve_clusters(options: DataFrame, labels: DataFrame, first_look: int, schema: str) -> DataFrame:
    """Solve the clusters of `labels` (major, choice_group_id, cluster), with longer lists where they are asked for."""
    todo = options.join(labels, GROUP).withColumn("look", F.lit(first_look))
    names, done = todo.columns, None
    while True:
        offered = todo.where(F.col("rank") <= F.col("look") + 1)
        solved = stage(offered.groupBy("major", "cluster").applyInPandas(_solve_cluster, schema)).df
        settled = solved.where("state != 'short'")
        done = settled if done is None else done.unionByName(settled)
        short = stage(solved.where("state = 'short'").select(*GROUP, "cluster", (F.col("look") * 4).alias("longer")))
        if short.rows == 0:
            return done
        again = todo.join(short.df.select("major", "cluster").distinct(), ["major", "cluster"], "left_semi")
        again = again.join(short.df.drop("cluster"), GROUP, "left")
        todo = again.withColumn("look", F.coalesce("longer", "look")).select(*names)


def _node(cluster: str) -> Column:
    return F.struct("major", F.col(cluster).alias("id"))


def rival_clusters(options: DataFrame, first_look: int) -> DataFrame:
    """The final picks with `cluster`, `price` of the course and `profit` of the group; majors without a solution are missing."""
    kind = options.schema["choice_group_id"].dataType.simpleString()
    schema = FIELDS.format(id=kind) + ", look int, state string, price double, profit double"
    options = options.select(*COLUMNS[:-1])
    picks = stage(
        options.where("rank = 1").withColumn("cluster", F.col("choice_group_id"))
        .withColumns({"look": F.lit(first_look), "state": F.lit("picked"), "price": F.lit(0.0), "profit": F.col("value")})
    ).df
    while True:
        shared = picks.groupBy("major", "course").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"))
        shared = shared.where("low < high").select("major", "course", "low")
        links = stage(
            picks.join(shared, ["major", "course"]).where("cluster != low")
            .select(_node("low").alias("a"), _node("cluster").alias("b")).distinct()
        )
        if links.rows == 0:
            return picks
        merged = components(links.df).select("node.major", F.col("node.id").alias("cluster"), F.col("root.id").alias("into"))
        labelled = stage(picks.join(merged, ["major", "cluster"], "left")).df
        labels = labelled.where("into IS NOT NULL").select(*GROUP, F.col("into").alias("cluster"))
        solved = stage(_solve_clusters(options, labels, first_look, schema)).df
        stuck = solved.where("state = 'stuck'").select("major").distinct()
        kept = labelled.where("into IS NULL").drop("into").unionByName(solved.where("state = 'picked'"))
        picks = stage(kept.join(stuck, "major", "left_anti")).df


def _first_plan(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the plans of equal value the first one, among groups connected by options at their price."""
    options, places, _ = _read(rows.assign(look=rows["rank"]))
    mine = rows[rows["held"]]
    found = Assignment(
        dict(zip(mine["choice_group_id"], mine["course"])), dict(zip(mine["choice_group_id"], mine["profit"])),
        dict(zip(rows["course"], rows["price"])), set(),
    )
    first = first_of_best(options, places, found)
    return rows[[first[g] == c for g, c in zip(rows["choice_group_id"], rows["course"])]]


def clustered_picks(options: DataFrame, first_look: int) -> DataFrame:
    """(major, choice_group_id, rank) of the picks, as `choice.major_picks` gives them."""
    picks = rival_clusters(options, first_look)
    profits = picks.select(*GROUP, "profit", F.col("course").alias("_held"))
    prices = picks.select("major", "course", "price")
    worth = F.col("value") - F.coalesce("price", F.lit(0.0)) >= F.col("profit") - SAME
    tight = stage(
        options.select(*COLUMNS[:-1]).join(profits, GROUP).join(prices, ["major", "course"], "left").where(worth)
        .select(*COLUMNS[:-1], "profit", F.coalesce("price", F.lit(0.0)).alias("price"), (F.col("_held") == F.col("course")).alias("held"))
    ).df
    shared = tight.groupBy("major", "course").agg(
        F.min("choice_group_id").alias("low"), F.max("choice_group_id").alias("high")
    ).where("low < high").select("major", "course", "low")
    links = tight.join(shared, ["major", "course"]).where("choice_group_id != low").select(
        _node("low").alias("a"), _node("choice_group_id").alias("b")
    ).distinct()
    roots = components(stage(links).df).select(
        "node.major", F.col("node.id").alias("choice_group_id"), F.col("root.id").alias("root")
    )
    tied = stage(tight.join(roots, GROUP, "left").withColumn("cluster", F.coalesce("root", "choice_group_id")).drop("root")).df
    # Where each group has one option at its price there is one plan.
    open_ = tied.groupBy("major", "cluster").agg(F.count_if(~F.col("held")).alias("n")).where("n > 0").drop("n")
    settled = (
        tied.join(open_, ["major", "cluster"], "left_semi").groupBy("major", "cluster").applyInPandas(_first_plan, tied.schema)
    )
    plain = tied.join(open_, ["major", "cluster"], "left_anti").where("held")
    return plain.select(*GROUP, "rank").unionByName(settled.select(*GROUP, "rank"))
