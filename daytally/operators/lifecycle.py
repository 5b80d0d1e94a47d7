"""Sign-ups, account deletions, class creations and class deletions: one row per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.functions import normalize, predicates
from daytally.operators.carry import carry_forward
from daytally.schema import NULL_TEXT, Endpoints

KINDS = ("user", "user-del", "class", "class-del")


def lifecycle_events(log: DataFrame, kinds: Sequence[str] = KINDS, endpoints: Endpoints = Endpoints()) -> DataFrame:
    """The events of the given kinds, found in one scan, with the role as logged."""
    known = predicates.lifecycle_kinds(endpoints)
    hits = F.array_compact(F.array(*[F.when(known[kind], F.lit(kind)) for kind in kinds]))
    # Holds for every kind; stated by itself, it reaches the scan.
    candidate = predicates.status_is("200") & F.col("method").isin("POST", "DELETE") & F.col("api").isNotNull()
    return log.where(candidate).select(
        F.explode(hits).alias("kind"),
        "log_date",
        "ftime",
        "event_id",
        "role",
        normalize.device_literal(F.col("device")).alias("device"),
        "country",
        normalize.language(F.col("language"), fill=False).alias("lang"),
        normalize.grade(F.col("grade")).alias("grade"),
    )


def lifecycle(log: DataFrame, kinds: Sequence[str] = KINDS, endpoints: Endpoints = Endpoints()) -> DataFrame:
    """`lifecycle_events`, where an empty role takes the last one seen among events of its kind that day."""
    return carry_forward(
        lifecycle_events(log, kinds, endpoints),
        "role",
        partition=["kind", "log_date"],
        order=["ftime", "event_id"],
        initial=NULL_TEXT,
    )
