"""DuckDB counterparts of the registered queries: the direct, unoptimised formulation of each."""

from __future__ import annotations

_WWW = "https://www.example.com/api"
_OAUTH = "https://oauth.example.com"

# The client log, derived from `events`: column name and definition.
_LOG_COLUMNS = {
    "event_id": "event_id",
    "log_date": "cast(ts AS date)",
    "ftime": "concat(substr(replace(cast(ts AS string), ' ', 'T'), 1, 19), 'Z')",
    "api": f"""CASE
        WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '{_WWW}/users'
        WHEN event_type = 'signup' AND event_id % 3 = 1 THEN '{_OAUTH}/v1/oauth2/sign_up'
        WHEN event_type = 'signup' THEN '{_OAUTH}/api/users'
        WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN '{_WWW}/classes'
        WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN concat('{_WWW}/classes/', cast(user_id AS string), '/')
        WHEN event_type = 'purchase' THEN concat('{_WWW}/classes/', cast(user_id AS string))
        WHEN event_type = 'error' AND event_id % 7 = 0 THEN concat('{_WWW}/users/', cast(user_id AS string), '/photo')
        WHEN event_type = 'error' THEN concat('{_WWW}/users/', cast(user_id AS string))
        WHEN event_type = 'view' AND event_id % 4 = 0 THEN 'page_move'
        WHEN event_type = 'view' AND event_id % 4 = 1 THEN '_null'
        WHEN event_type = 'view' AND event_id % 4 = 2 THEN NULL
        WHEN event_type IN ('view', 'click') THEN '{_WWW}/feed'
        END""",
    "method": """CASE
        WHEN event_type IN ('signup', 'click') THEN 'POST'
        WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'POST'
        WHEN event_type IN ('purchase', 'error') THEN 'DELETE'
        WHEN event_type = 'view' THEN 'GET'
        END""",
    "code": """CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 10 = 0 THEN '400'
        WHEN event_id % 13 = 0 THEN '500' ELSE '200' END""",
    "id": """CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN ''
        ELSE concat(cast(user_id AS string), '-', cast(event_id % 20 AS string)) END""",
    "role": """CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'teacher' WHEN 3 THEN 'student'
        WHEN 4 THEN 'parent' ELSE 'student' END""",
    "device": """CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'web.event' WHEN 2 THEN 'ios'
        WHEN 3 THEN 'pageevent' ELSE 'android' END""",
    "tag": """CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ios.event' WHEN 2 THEN 'android.event'
        ELSE 'web' END""",
    "country": "CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'US' WHEN 2 THEN 'JP' ELSE 'KR' END",
    "language": "CASE event_id % 7 WHEN 1 THEN NULL WHEN 2 THEN 'en' ELSE 'ko' END",
    "grade": """CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'n/a'
        ELSE cast(event_id % 12 AS string) END""",
    "target_type": "CASE event_type WHEN 'click' THEN 'class' WHEN 'view' THEN 'user' END",
    "target_id": """CASE WHEN event_type = 'click' AND event_id % 29 <> 0
        THEN concat('c', cast(user_id % 50 AS string)) END""",
    "resource_type": """CASE WHEN event_type = 'click' THEN CASE event_id % 9
        WHEN 0 THEN 'texthome' WHEN 1 THEN 'filehome' WHEN 2 THEN 'photohome' WHEN 3 THEN 'videohome'
        WHEN 4 THEN 'sharehome' WHEN 5 THEN 'photos' WHEN 6 THEN 'notice' WHEN 7 THEN 'comment' END END""",
}

_LOG = "log AS (SELECT {} FROM events)".format(", ".join(f"{sql} AS {name}" for name, sql in _LOG_COLUMNS.items()))

_GRADE = "CASE WHEN grade IS NULL THEN -999 ELSE TRY_CAST(trunc(TRY_CAST(grade AS DECIMAL(38, 18))) AS BIGINT) END"
_TAG = "CASE WHEN tag IS NULL THEN '_null' ELSE regexp_replace(tag, '.event', '', 'g') END"
_DEVICE_REGEX = f"CASE WHEN device IS NULL THEN {_TAG} ELSE regexp_replace(device, '.event', '', 'g') END"
_DEVICE_LITERAL = "CASE WHEN device IS NULL THEN 'null' ELSE replace(device, '.event', '') END"

_URLS = "('https://www.example.com/api/users', 'https://oauth.example.com/v1/oauth2/sign_up', \
'https://oauth.example.com/api/users')"
_IS_SIGNUP = f"(api IN {_URLS} AND method = 'POST' AND code = '200')"
_REAL_CALL = "(api IS NOT NULL AND api <> 'page_move' AND api <> '_null')"


def _deleted(url: str) -> str:
    return f"""(contains(api, '{url}') AND method = 'DELETE' AND code = '200'
        AND len(string_split(rtrim(api, '/'), '/')) = 6)"""


_KIND = {
    "user": _IS_SIGNUP,
    "user-del": _deleted("https://www.example.com/api/users"),
    "class": "(api = 'https://www.example.com/api/classes' AND method = 'POST' AND code = '200')",
    "class-del": _deleted("https://www.example.com/api/classes"),
}

_ACTIVE = {
    "user": (f"{_REAL_CALL} AND id IS NOT NULL AND id <> '' AND code IS DISTINCT FROM '400'", "id"),
    "class": (
        """target_type = 'class' AND resource_type IN ('texthome', 'filehome', 'photohome', 'videohome',
        'sharehome', 'photos', 'notice') AND code IS DISTINCT FROM '400'""",
        "target_id",
    ),
}

_DIMS = "subject, id, role, device, country, lang, grade"


def _active(subject: str) -> str:
    condition, id_column = _ACTIVE[subject]
    return f"""active AS (SELECT log_date, '{subject}' AS subject, {id_column} AS id, role, {_DEVICE_REGEX} AS device, country,
        coalesce(language, '_null') AS lang, {_GRADE} AS grade FROM log WHERE {condition})"""


def _days(first: str, last: str) -> str:
    return f"""days AS (SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE)
        AS date)"""


_TARGETS = _days("2024-01-01", "2024-01-30")


def _counts(subject: str, windows: str = "(1), (7), (30)", days: str = _TARGETS) -> str:
    """CTEs that end in `counts`: events of each window counted directly."""
    return f"""{_LOG}, {_active(subject)}, {days}, windows(window_days) AS (VALUES {windows}),
        counts AS (SELECT date, window_days, {_DIMS}, count(*) AS unique_cnt
        FROM active JOIN (SELECT * FROM days CROSS JOIN windows) targets
        ON log_date <= date AND log_date > date - window_days
        GROUP BY date, window_days, {_DIMS})"""


def _rolling(subject: str) -> str:
    return f"WITH {_counts(subject)} SELECT date, window_days, {_DIMS}, unique_cnt FROM counts"


def _last_day(subject: str) -> str:
    days = _days("2024-01-30", "2024-01-30")
    return f"WITH {_counts(subject, days=days)} SELECT date, window_days, {_DIMS}, unique_cnt FROM counts"


def _one_window(subject: str, window: int) -> str:
    return f"WITH {_counts(subject, f'({window})')} SELECT date, {_DIMS}, unique_cnt FROM counts"


def _without_device(subject: str) -> str:
    return f"""WITH {_counts(subject, '(7)')} SELECT date, window_days, subject, id, role, '_all' AS device, country, lang,
        CAST(0 AS BIGINT) AS grade, CAST(sum(unique_cnt) AS BIGINT) AS unique_cnt
        FROM counts GROUP BY date, window_days, subject, id, role, country, lang"""


def _unique_stats(subject: str) -> str:
    return f"""WITH {_counts(subject)} SELECT id, role, device, country, unique_cnt,
        strftime(date, '%Y%m%d') AS date, lang, grade,
        strftime(date, '%a %b %d 00:00:00 UTC %Y') AS "timeStamp",
        'unique-stats-' || strftime(date, '%Y') AS _index,
        '{subject}' || window_days || 'd-nodev' AS _type FROM counts"""


def _rollup(subject: str) -> str:
    return f"""WITH {_LOG}, {_active(subject)} SELECT log_date, {_DIMS}, count(*) AS unique_cnt
        FROM active GROUP BY log_date, {_DIMS}"""


def _events(*kinds: str) -> str:
    """CTEs that end in `events`: lifecycle events with the role carried forward."""
    found = " UNION ALL ".join(f"SELECT '{kind}' AS kind, * FROM log WHERE {_KIND[kind]}" for kind in kinds)
    # A missing role is a value of its own; chr(1) stands for it while it is carried.
    return f"""{_LOG}, found AS ({found}), marked AS (SELECT *, CASE WHEN role IS NULL THEN chr(1)
        WHEN role <> '' THEN role END AS mark FROM found),
        events AS (SELECT kind, log_date, ftime, event_id,
        nullif(coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY kind, log_date
            ORDER BY ftime NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '_null'), chr(1))
            AS role,
        {_DEVICE_LITERAL} AS device, country, language AS lang, {_GRADE} AS grade FROM marked)"""


def _lifecycle(kind: str) -> str:
    return f"WITH {_events(kind)} SELECT * EXCLUDE (kind) FROM events"


def _flags(signup: tuple[str, str], *activity: tuple[str, str]) -> str:
    """CTEs with the ids that signed up, and for each activity period the ids that were active."""
    ids = [
        f"""signed AS (SELECT DISTINCT id FROM log WHERE id IS NOT NULL AND {_IS_SIGNUP}
        AND log_date BETWEEN DATE '{signup[0]}' AND DATE '{signup[1]}')"""
    ]
    for number, (first, last) in enumerate(activity):
        ids.append(
            f"""active_{number} AS (SELECT DISTINCT id FROM log WHERE id IS NOT NULL AND {_REAL_CALL}
        AND log_date BETWEEN DATE '{first}' AND DATE '{last}')"""
        )
    return ", ".join([_LOG, *ids])


def _retention(signup: tuple[str, str], activity: tuple[str, str]) -> str:
    return f"""WITH {_flags(signup, activity)},
        n AS (SELECT (SELECT count(*) FROM signed) AS signup,
        (SELECT count(*) FROM signed WHERE id IN (SELECT id FROM active_0)) AS retained)
        SELECT signup, retained, coalesce(round(CAST(retained AS DOUBLE) / nullif(signup, 0) * 100, 3), 0.0)
        AS retained_pct FROM n"""


_SIGNUP_HALF, _ACTIVE_HALF = ("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-30")


def _cohort_days(signup_days: tuple[int, int], activity_days: tuple[int, int]) -> str:
    """CTEs that end in `cohorts`: retention per target day, with each day's windows looked up on their own."""
    return f"""{_LOG}, {_days("2024-01-02", "2024-01-31")},
        signed AS (SELECT DISTINCT date, id FROM log JOIN days
            ON log_date BETWEEN date - {signup_days[0]} AND date - {signup_days[1]}
            WHERE id IS NOT NULL AND {_IS_SIGNUP}),
        active AS (SELECT DISTINCT date, id FROM log JOIN days
            ON log_date BETWEEN date - {activity_days[0]} AND date - {activity_days[1]}
            WHERE id IS NOT NULL AND {_REAL_CALL}),
        totals AS (SELECT days.date, count(signed.id) AS signup, count(active.id) AS retained
            FROM days LEFT JOIN signed ON signed.date = days.date
            LEFT JOIN active ON active.date = signed.date AND active.id = signed.id GROUP BY days.date),
        cohorts AS (SELECT date, signup, retained,
            coalesce(round(CAST(retained AS DOUBLE) / nullif(signup, 0) * 100, 3), 0.0) AS retained_pct FROM totals)"""


# Every target day with its sign-up window and two lags, each looked up on its own.
_CURVES = f"""WITH {_LOG}, {_days("2024-01-25", "2024-01-31")},
    lags AS (SELECT * FROM (VALUES (1, 20, 11), (2, 10, 1)) AS v(lag, farthest, nearest)),
    signed AS (SELECT DISTINCT date, id FROM log JOIN days ON log_date BETWEEN date - 30 AND date - 21
        WHERE id IS NOT NULL AND {_IS_SIGNUP}),
    active AS (SELECT DISTINCT date, lag, id FROM log JOIN (SELECT * FROM days, lags)
        ON log_date BETWEEN CAST(date - farthest AS DATE) AND CAST(date - nearest AS DATE)
        WHERE id IS NOT NULL AND {_REAL_CALL}),
    totals AS (SELECT days.date, lags.lag, count(signed.id) AS signup, count(active.id) AS retained
        FROM days CROSS JOIN lags LEFT JOIN signed ON signed.date = days.date
        LEFT JOIN active ON active.date = signed.date AND active.lag = lags.lag AND active.id = signed.id
        GROUP BY days.date, lags.lag)
    SELECT date, lag, signup, retained,
        coalesce(round(CAST(retained AS DOUBLE) / nullif(signup, 0) * 100, 3), 0.0) AS retained_pct FROM totals"""


ORACLES: dict[str, str] = {
    "calendar": f"""WITH {_LOG}, {_days("2024-01-01", "2024-01-31")}
        SELECT date, CAST(date - 1 AS DATE) AS previous_date, count(event_id) AS lines
        FROM days LEFT JOIN log ON log_date = date GROUP BY date""",
    "ensure_columns": f"""WITH {_LOG} SELECT event_id, api, country, CAST(-999 AS BIGINT) AS grade,
        '_null' AS role, '_null' AS device, '_null' AS language FROM log""",
    "normalize_grade_code": f"""WITH {_LOG} SELECT event_id, {_GRADE} AS grade,
        coalesce(code, '_null') AS code FROM log""",
    "device_with_tag_fallback": f"WITH {_LOG} SELECT event_id, {_DEVICE_REGEX} AS device FROM log",
    "device_literal": f"WITH {_LOG} SELECT event_id, {_DEVICE_LITERAL} AS device FROM log",
    "local_date": "SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS kr_date FROM events",
    "kst_archive": f"""WITH {_LOG}, {_days("2024-01-01", "2024-01-31")}
        SELECT log.* REPLACE ({_GRADE} AS grade, coalesce(code, '_null') AS code), date AS kr_date
        FROM log JOIN days ON log_date BETWEEN date - 1 AND date
        AND ftime BETWEEN concat(strftime(date - 1, '%Y-%m-%d'), 'T15') AND concat(strftime(date, '%Y-%m-%d'), 'T15')""",
    "active_user_events": f"WITH {_LOG}, {_active('user')} SELECT * FROM active",
    "active_class_events": f"WITH {_LOG}, {_active('class')} SELECT * FROM active",
    "daily_user_rollup": _rollup("user"),
    "daily_class_rollup": _rollup("class"),
    "unique_user_1d": _one_window("user", 1),
    "unique_user_7d": _one_window("user", 7),
    "unique_user_30d": _one_window("user", 30),
    "unique_class_1d": _one_window("class", 1),
    "unique_class_7d": _one_window("class", 7),
    "unique_class_30d": _one_window("class", 30),
    "unique_user_last_day": _last_day("user"),
    "unique_class_last_day": _last_day("class"),
    "rolling_user_counts": _rolling("user"),
    "rolling_class_counts": _rolling("class"),
    "rolling_counts_one_scan": f"SELECT * FROM ({_rolling('user')}) UNION ALL SELECT * FROM ({_rolling('class')})",
    "unique_user_nodev": _without_device("user"),
    "unique_class_nodev": _without_device("class"),
    "publish_unique_stats": _unique_stats("user"),
    "publish_unique_class_stats": _unique_stats("class"),
    "user_signups": _lifecycle("user"),
    "user_deletions": _lifecycle("user-del"),
    "class_creations": _lifecycle("class"),
    "class_deletions": _lifecycle("class-del"),
    "lifecycle_all": f"WITH {_events(*_KIND)} SELECT * FROM events",
    "role_carry_forward": f"WITH {_events('user')} SELECT log_date, ftime, event_id, role FROM events",
    "publish_accum_stats": f"""WITH {_events(*_KIND)} SELECT role, device, country,
        strftime(log_date, '%Y%m%d') AS date, lang, grade,
        strftime(log_date, '%a %b %d 00:00:00 UTC %Y') AS "timeStamp",
        'accum-stats-' || strftime(log_date, '%Y') AS _index, replace(kind, '-del', '') AS _type, kind FROM events""",
    "distinct_active_ids": f"WITH {_LOG} SELECT DISTINCT id FROM log WHERE id IS NOT NULL AND {_REAL_CALL}",
    "cohort_same_window": _retention(("2024-01-01", "2024-01-30"), ("2024-01-01", "2024-01-30")),
    "cohort_prior_window": _retention(_SIGNUP_HALF, _ACTIVE_HALF),
    "cohort_churned_ids": f"""WITH {_flags(_SIGNUP_HALF, _ACTIVE_HALF)}
        SELECT id FROM signed WHERE id NOT IN (SELECT id FROM active_0)""",
    "cohort_curve": f"""WITH {_flags(("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-30"))},
        counted AS (
            SELECT 1 AS lag, (SELECT count(*) FROM signed WHERE id IN (SELECT id FROM active_0)) AS retained
            UNION ALL
            SELECT 2, (SELECT count(*) FROM signed WHERE id IN (SELECT id FROM active_1))),
        n AS (SELECT lag, (SELECT count(*) FROM signed) AS signup, retained FROM counted)
        SELECT lag, signup, retained,
        coalesce(round(CAST(retained AS DOUBLE) / nullif(signup, 0) * 100, 3), 0.0) AS retained_pct FROM n""",
    "cohort_same_window_by_day": f"WITH {_cohort_days((30, 1), (30, 1))} SELECT * FROM cohorts",
    "cohort_prior_window_by_day": f"WITH {_cohort_days((20, 11), (10, 1))} SELECT * FROM cohorts",
    "publish_cohort": f"""WITH {_cohort_days((30, 1), (30, 1))} SELECT signup, strftime(date, '%Y%m%d') AS date,
        1 AS "lastMonths", strftime(date, '%a %b %d 00:00:00 UTC %Y') AS submit,
        strftime(date, '%a %b %d 00:00:00 UTC %Y') AS timestamp, 'cohort-' || strftime(date, '%Y') AS _index,
        strftime(date - INTERVAL 2 MONTH, '%Y%m') AS _type, retained_pct AS "last1M", retained AS "last1M_cnt"
        FROM cohorts""",
    "daily_ids": f"""WITH {_LOG} SELECT log_date, id, bool_or(coalesce({_IS_SIGNUP}, false)) AS signed_up
        FROM log WHERE id IS NOT NULL AND {_REAL_CALL} AND log_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
        GROUP BY log_date, id""",
    "cohort_from_daily_ids": f"WITH {_cohort_days((20, 11), (10, 1))} SELECT * FROM cohorts",
    "cohort_curve_by_day": _CURVES,
}
