"""Which log lines count as what. All are plain Column predicates, so Spark can push them into the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daytally.schema import API_MARKERS, WRITING_TYPES, Endpoints


def not_status(code: str) -> Column:
    """A missing status is not `code`, so it passes."""
    return ~F.col("code").eqNullSafe(code)


def status_is(code: str) -> Column:
    return F.col("code") == code


def real_call() -> Column:
    """A missing `api` is none; stated by itself, that reaches the scan."""
    return F.col("api").isNotNull() & ~F.col("api").isin(*API_MARKERS)


def user_activity() -> Column:
    return real_call() & (F.col("id") != "") & not_status("400")


def class_activity() -> Column:
    """Writing in a class. A missing class id is kept and counts as a class of its own."""
    return (F.col("target_type") == "class") & F.col("resource_type").isin(*WRITING_TYPES) & not_status("400")


def cohort_activity() -> Column:
    """Unlike `user_activity`, failed calls and empty ids count."""
    return real_call() & F.col("id").isNotNull()


def endpoint_created(urls: Iterable[str]) -> Column:
    return F.col("api").isin(*urls) & (F.col("method") == "POST") & status_is("200")


def endpoint_deleted(url: str) -> Column:
    """A DELETE on `url`, or on one whose path merely starts alike, with six parts between slashes.

    Trailing slashes add no part.
    """
    parts = F.size(F.split(F.rtrim(F.col("api"), F.lit("/")), "/"))
    return F.col("api").contains(url) & (F.col("method") == "DELETE") & status_is("200") & (parts == 6)


def signup(endpoints: Endpoints) -> Column:
    return endpoint_created(endpoints.signup_urls)


def lifecycle_kinds(endpoints: Endpoints) -> dict[str, Column]:
    return {
        "user": signup(endpoints),
        "user-del": endpoint_deleted(endpoints.users),
        "class": endpoint_created(endpoints.class_create_urls),
        "class-del": endpoint_deleted(endpoints.classes),
    }
