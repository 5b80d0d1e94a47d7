"""View a plain `events` table (event_id, ts, user_id, event_type) as a client log.

The table has no URLs, roles or devices. They are derived from its columns such that every rule of the operators
meets each of its cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from daytally.schema import WRITING_TYPES, Endpoints


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _pick(*values: str | None) -> str:
    """One of the values, by the remainder of the event number. A constant array keeps the generated code short."""
    return f"get(array({', '.join(map(_text, values))}), cast(event_id % {len(values)} AS int))"


def _columns(endpoints: Endpoints, writing_types: Sequence[str]) -> dict[str, str]:
    feed = f"{endpoints.www}/api/feed"
    return {
        "event_id": "event_id",
        "log_date": "cast(ts AS date)",
        "ftime": "concat(replace(substr(cast(ts AS string), 1, 19), ' ', 'T'), 'Z')",
        "api": f"""CASE event_type
            WHEN 'signup' THEN {_pick(*endpoints.signup_urls)}
            WHEN 'purchase' THEN if(event_id % 2 = 0, '{endpoints.classes}',
                concat('{endpoints.classes}/', user_id, if(event_id % 5 = 0, '/', '')))
            WHEN 'error' THEN concat('{endpoints.users}/', user_id, if(event_id % 7 = 0, '/photo', ''))
            WHEN 'view' THEN {_pick("page_move", "_null", None, feed)}
            WHEN 'click' THEN '{feed}' END""",
        "method": """CASE event_type WHEN 'signup' THEN 'POST' WHEN 'click' THEN 'POST' WHEN 'view' THEN 'GET'
            WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN if(event_id % 2 = 0, 'POST', 'DELETE') END""",
        "code": """CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 10 = 0 THEN '400'
            WHEN event_id % 13 = 0 THEN '500' ELSE '200' END""",
        "id": """CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN ''
            ELSE concat(user_id, '-', event_id % 20) END""",
        "role": _pick(None, "", "teacher", "student", "parent", "student"),
        "device": _pick(None, "web.event", "ios", "pageevent", "android"),
        "tag": _pick(None, "ios.event", "android.event", "web"),
        "country": _pick(None, "US", "JP", "KR", "KR", "KR", "KR", "KR"),
        "language": _pick("ko", None, "en", "ko", "ko", "ko", "ko"),
        "grade": """CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'n/a'
            ELSE cast(event_id % 12 AS string) END""",
        "target_type": "CASE event_type WHEN 'click' THEN 'class' WHEN 'view' THEN 'user' END",
        "target_id": "if(event_type = 'click' AND event_id % 29 <> 0, concat('c', user_id % 50), NULL)",
        "resource_type": f"if(event_type = 'click', {_pick(*writing_types, 'comment', None)}, NULL)",
    }


def log_from_events(spark: SparkSession, table_dir: str) -> DataFrame:
    columns = _columns(Endpoints(), WRITING_TYPES)
    events = spark.read.parquet(f"{table_dir}/events.parquet")
    return events.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])
