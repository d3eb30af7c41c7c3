"""Join plan rows to course metrics, with a fallback for renamed subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import SUBJECT_ALIASES
from ..schemas import COURSE_KEY


def with_aliases(
    metrics: DataFrame, names: list[str], aliases: dict[str, list[str]] | None = None
) -> DataFrame:
    """Course metrics under the subjects plans use.

    Where a renamed subject has no mean of its own under a course number, all
    its metrics come from the first historical subject that has the number, or
    are null. Resolving this on the small side leaves one join for the plan.
    """
    aliases = SUBJECT_ALIASES if aliases is None else aliases
    if not aliases:
        return metrics.select(*COURSE_KEY, *names)
    of_history: dict[str, list[tuple[str, int]]] = {}
    for plan_subject, history in aliases.items():
        for priority, h in enumerate(history):
            of_history.setdefault(h, []).append((plan_subject, priority + 1))
    targets = F.create_map(
        *[
            x
            for h, plans in of_history.items()
            for x in (
                F.lit(h),
                F.array(*[F.struct(F.lit(p).alias("subject"), F.lit(i).alias("rank")) for p, i in plans]),
            )
        ]
    )
    # Each row stands for its own subject (rank 0) and for the plan subjects it backs.
    own = F.struct(F.col("course_subject").alias("subject"), F.lit(0).alias("rank"))
    backed = F.try_element_at(targets, F.col("course_subject"))
    roles = F.when(backed.isNull(), F.array(own)).otherwise(F.concat(F.array(own), backed))
    spread = metrics.select(F.explode(roles).alias("r"), "course_number", *names)
    value = F.struct(*names)
    # A renamed subject keeps its own row only if that row has a mean.
    usable = (F.col("r.rank") > 0) | ~F.col("r.subject").isin(list(aliases)) | F.col("mean_gpa").isNotNull()
    return (
        spread.groupBy(F.col("r.subject").alias("course_subject"), "course_number")
        .agg(F.min_by(F.when(usable, value), F.when(usable, F.col("r.rank"))).alias("v"))
        .select(*COURSE_KEY, *[F.col(f"v.{n}").alias(n) for n in names])
    )


def attach_metrics(
    plan: DataFrame,
    metrics: DataFrame,
    names: list[str],
    aliases: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Left-join course metrics onto plan rows by (subject, number); the plan is read once."""
    return plan.join(with_aliases(metrics, names, aliases), COURSE_KEY, "left").select(*plan.columns, *names)
