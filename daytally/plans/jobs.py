"""The daily jobs. Each covers its whole run period with one plan.

    spark-submit run_job.py JOB START NUM_DAYS --logs ROOT --out ROOT

`START` is the last target day (yyyyMMdd); the run goes back `NUM_DAYS` days from it.
"""

from __future__ import annotations

import argparse
import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.lineage import checkpoints, cut_lineage
from daytally.functions.normalize import COLUMN_DEFAULTS
from daytally.functions.periods import Period, run_period, span
from daytally.operators.activity import (
    DIMENSIONS,
    SUBJECTS,
    WINDOWS,
    daily_rollup,
    rolling_counts,
    unique_counts,
    without_device,
)
from daytally.operators.archive import local_archive
from daytally.operators.lifecycle import KINDS, lifecycle
from daytally.operators.publish import as_accum_stats, as_cohort, as_unique_stats, day_text
from daytally.operators.retention import curve_by_day, daily_ids, marks, reach_of, retention_by_day
from daytally.schema import LOG_SCHEMA, NULL_TEXT, Endpoints
from daytally.sources.catalogue import (
    CATALOGUE_SCHEMA,
    OWN_COLUMNS,
    RAW_PREFIX,
    DayLines,
    catalogue,
    columns_of,
    quality_of,
)
from daytally.sources.files import list_files, present_days
from daytally.sources.logs import REST, MissingDays, read_logs, table_columns
from daytally.sources.tables import read_table, write_partitioned

ROLLUP_SCHEMA = T.StructType(
    [T.StructField("log_date", T.DateType())]
    + [T.StructField(name, T.LongType() if name == "grade" else T.StringType()) for name in DIMENSIONS]
    + [T.StructField("unique_cnt", T.LongType())]
)
IDS_SCHEMA = T.StructType(
    [LOG_SCHEMA["log_date"], LOG_SCHEMA["id"], T.StructField("signed_up", T.BooleanType())]
)
SUBJECT = T.StructField("subject", T.StringType())
# What the stored rows of a day and subject were made from.
INPUTS_SCHEMA = T.StructType(
    [SUBJECT, T.StructField("log_date", T.DateType())]
    + [T.StructField(name, T.LongType()) for name in ("files", "bytes", "newest")]
)

# Days before the target day that a sign-up and an activity window span, as (farthest, nearest).
LAST_MONTH = (30, 1)
MONTH_BEFORE = (60, 31)
MONTH = 30


@dataclass(frozen=True)
class Settings:
    """What a job reads and where it writes. `main` explains the options."""

    logs: str
    out: str
    log_format: str = "json"
    file_glob: str | None = None
    allow_missing: bool = False
    rollup: str | None = None
    late_days: int = 0
    prior_signups: bool = False
    lags: int = 2
    quality: bool = False
    max_malformed: float | None = None
    endpoints: Endpoints = field(default_factory=Endpoints)

    def __post_init__(self) -> None:
        if self.file_glob and (self.rollup or self.log_format != "json"):
            raise ValueError("a sample by file pattern reads JSON logs and feeds no rollup")

    @property
    def results(self) -> str:
        """A sample has results of its own, which replace nothing."""
        return f"{self.out}/sample" if self.file_glob else self.out


class TooManyMalformed(ValueError):
    """A day has more malformed lines than the job was told to accept."""


def _log(
    spark: SparkSession, settings: Settings, period: Period, extra: Iterable[str] = (), rest: bool = False
) -> DataFrame:
    return read_logs(
        spark,
        settings.logs,
        period,
        fmt=settings.log_format,
        file_glob=settings.file_glob,
        extra=list(extra),
        rest=rest,
        allow_missing=settings.allow_missing,
    )


def _facts(spark: SparkSession, settings: Settings, period: Period) -> DataFrame:
    """The catalogue of the JSON lines that are read, from one pass; where a rollup is kept, from one pass over new days.

    Tells what the lines are like, and ends the job, before it has written anything, if a day has too many malformed ones.
    """
    if settings.rollup:
        schema = T.StructType([SUBJECT, *CATALOGUE_SCHEMA.fields])

        def make(days: Period) -> DataFrame:
            return catalogue(spark, settings.logs, days).select(F.lit("lines").alias("subject"), "*")

        lenient = replace(settings, allow_missing=True)
        facts = _refresh(spark, lenient, period, ("lines",), f"{settings.rollup}-catalogue", schema, make)
    else:
        facts = cut_lineage(catalogue(spark, settings.logs, period, settings.file_glob))
    days = quality_of(facts)
    _report(days, settings.quality)
    if settings.max_malformed is not None:
        bad = [f"{d.log_date}: {d.malformed} of {d.lines}" for d in days if d.malformed > settings.max_malformed * d.lines]
        if bad:
            raise TooManyMalformed(", ".join(bad))
    return facts


def _report(days: list[DayLines], each: bool) -> None:
    for day in days if each else []:
        print(f"{day.log_date}: {day.lines} lines, {day.malformed} malformed, {day.bad_grades} bad grades")
    lines, malformed, bad = (sum(getattr(d, name) for d in days) for name in ("lines", "malformed", "bad_grades"))
    print(f"{len(days)} days read: {lines} lines, {malformed} malformed, {bad} bad grades")


def _columns(spark: SparkSession, settings: Settings, period: Period) -> tuple[list[str], bool]:
    """The columns that any line that is read has, and whether some lines have more."""
    if settings.log_format != "json":
        return table_columns(spark, settings.logs, period)
    return columns_of(_facts(spark, settings, period))


def _absent(spark: SparkSession, settings: Settings, period: Period, *names: str) -> set[str]:
    if not present_days(spark, settings.logs, period, settings.log_format):
        return set()
    return set(names) - set(_columns(spark, settings, period)[0])


def _activity_log(spark: SparkSession, settings: Settings, period: Period) -> DataFrame:
    """The log with the defaults of columns that no line has; a value that is merely missing stays so."""
    absent = _absent(spark, settings, period, "role", "device", "country")
    return _log(spark, settings, period).withColumns({name: F.lit(COLUMN_DEFAULTS[name]) for name in absent})


def _lifecycle_log(spark: SparkSession, settings: Settings, period: Period) -> DataFrame:
    """As `_activity_log`, but where no line has a device, the tag takes its place."""
    absent = _absent(spark, settings, period, "role", "country", "language", "device", "tag")
    fill = {name: F.lit(NULL_TEXT) for name in absent - {"tag"}}
    if "device" in absent and "tag" not in absent:
        fill["device"] = F.col("tag")
    return _log(spark, settings, period).withColumns(fill)


def _days(spark: SparkSession, settings: Settings, targets: Period) -> list[date]:
    """The target days that may be replaced: all, or with `allow_missing` those that the log has."""
    if not settings.allow_missing:
        return targets.days()
    present = present_days(spark, settings.logs, targets, settings.log_format)
    return [day for day in targets.days() if day in present]


def _write_records(records: DataFrame, path: str, days: list[date], kinds: tuple[str, ...] = ()) -> None:
    """Write records by `kind`, if there are several, and by `date`."""
    replaces = F.col("date").isin([f"{day:%Y%m%d}" for day in days])
    if not days:
        return
    if kinds:
        write_partitioned(records.where(replaces), path, ["kind", "date"], replaces & F.col("kind").isin(*kinds))
    else:
        write_partitioned(records.where(replaces), path, ["date"], replaces)


def columnar_log(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Store the lines, with all columns that any of them has, as Parquet by UTC day.

    The other jobs then read only the columns they need. Columns that are not known are text.
    """
    names, rest = _columns(spark, settings, targets)
    log = _log(spark, settings, targets, names, rest)
    days = _days(spark, settings, targets)
    # A column that no line has is left out, so that it is still told from one that is empty.
    log = log.select("event_id", "log_date", *[c for c in log.columns[2:] if c in names or c == REST.name]).where(F.col("log_date").isin(days))
    # A file holds one day, so each task writes one file per file it reads: nothing to shuffle.
    write_partitioned(
        log, settings.results, ["log_date"], F.col("log_date").isin(days), compression="zstd", rebalance=False
    )


def archive(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Local-day archive, with all columns that any line has; those that are not known are text on every day."""
    needed, reads = targets.widen(1), targets.widen(1, settings.late_days)
    present = present_days(spark, settings.logs, reads, settings.log_format)
    if not settings.allow_missing and (missing := sorted(set(needed.days()) - present)):
        raise MissingDays(", ".join(map(str, missing)))
    names, rest = _columns(spark, settings, reads)
    # Later days may still be to come.
    log = _log(spark, replace(settings, allow_missing=True), reads, names, rest)
    archived = local_archive(log, targets, settings.late_days)
    days = [day for day in targets.days() if day in present]
    if not days:
        return
    replaces = F.col("kr_date").isin(days)
    own = {f"{RAW_PREFIX}{name}": name for name in OWN_COLUMNS if name not in ("kr_date", REST.name)}
    archived = archived.drop("event_id", "log_date").withColumnsRenamed(own)
    # A file of the log spans at most a few local days, so each task writes few files: nothing to shuffle.
    write_partitioned(
        archived.where(replaces),
        f"{settings.results}/utc9",
        ["kr_date"],
        replaces,
        compression="gzip",
        rebalance=False,
    )


def read_archive(spark: SparkSession, out: str) -> DataFrame:
    """The local-day archive with the columns of all its days."""
    return spark.read.option("mergeSchema", True).parquet(f"{out}/utc9")


def _inputs(spark: SparkSession, settings: Settings, period: Period) -> dict[date, tuple[int, int, int]]:
    """Per day of the log the number of its files, their bytes, and when the newest was written."""
    files = list_files(spark, settings.logs, period, settings.log_format)
    if files is None:
        return {}
    newest = F.max(F.unix_micros(F.col("modificationTime").cast("timestamp")))
    rows = files.groupBy("log_date").agg(F.count("*"), F.sum("length"), newest).collect()
    return {row[0]: tuple(row)[1:] for row in rows}


def _refresh(
    spark: SparkSession,
    settings: Settings,
    needed: Period,
    subjects: tuple[str, ...],
    path: str,
    schema: T.StructType,
    make: Callable[[Period], DataFrame],
) -> DataFrame:
    """Bring the table that is stored by subject and day up to date and return it.

    Days whose files are not those it was made from are made anew; files that came late or were replaced count as well.
    """
    current = _inputs(spark, settings, needed)
    if not settings.allow_missing and (missing := sorted(set(needed.days()) - set(current))):
        raise MissingDays(", ".join(map(str, missing)))
    is_subject, stamps = F.col("subject").isin(*subjects), f"{path}-inputs"
    known = read_table(spark, stamps, INPUTS_SCHEMA).select(INPUTS_SCHEMA.names)
    known = known.where(is_subject & needed.contains(F.col("log_date")))
    done = {(row.subject, row.log_date): tuple(row)[2:] for row in known.collect()}
    changed = [day for day in needed.days() if day in current and any(done.get((s, day)) != current[day] for s in subjects)]
    for period in _stretches(changed):
        replaces = is_subject & period.contains(F.col("log_date"))
        write_partitioned(make(period), path, ["subject", "log_date"], replaces, compression="zstd")
        rows = [(subject, day, *current[day]) for subject in subjects for day in period.days()]
        write_partitioned(spark.createDataFrame(rows, INPUTS_SCHEMA), stamps, ["subject", "log_date"], replaces)
    return read_table(spark, path, schema).where(is_subject & needed.contains(F.col("log_date")))


def _refresh_rollup(spark: SparkSession, settings: Settings, targets: Period, subjects: tuple[str, ...]) -> DataFrame:
    """The stored rollup, up to date for the windows of the target days."""
    return _refresh(
        spark,
        settings,
        targets.widen(before=max(WINDOWS) - 1),
        subjects,
        settings.rollup,
        ROLLUP_SCHEMA,
        lambda period: daily_rollup(_activity_log(spark, settings, period), subjects),
    )


def _marked(spark: SparkSession, settings: Settings, reach: Period) -> DataFrame:
    """Sign-ups and activity of ids by day: the stored sets, up to date, where a rollup is kept; else the log itself."""
    watched = settings.log_format == "json" and (settings.rollup or settings.quality or settings.max_malformed is not None)
    if not settings.rollup:
        log = _log(spark, settings, reach)
        if watched:
            _facts(spark, settings, reach)
        return marks(log, reach, settings.endpoints)
    # What is a sign-up depends on the addresses, so each pair of them has sets of its own.
    subject = hashlib.sha256(f"{settings.endpoints.www} {settings.endpoints.oauth}".encode()).hexdigest()[:16]

    def make(period: Period) -> DataFrame:
        if watched:
            _facts(spark, settings, period)
        ids = daily_ids(_log(spark, settings, period), period, settings.endpoints)
        return ids.select(F.lit(subject).alias("subject"), *IDS_SCHEMA.names)

    schema = T.StructType([SUBJECT, *IDS_SCHEMA.fields])
    return _refresh(spark, settings, reach, (subject,), f"{settings.rollup}-ids", schema, make)


def _stretches(days: list[date]) -> list[Period]:
    """The given days, in order, as periods without gaps."""
    periods: list[Period] = []
    for day in days:
        if periods and periods[-1].last + timedelta(days=1) == day:
            periods[-1] = Period(periods[-1].first, day)
        else:
            periods.append(Period(day, day))
    return periods


def _activity(spark: SparkSession, settings: Settings, targets: Period, subjects: tuple[str, ...]) -> None:
    reads = targets.widen(before=max(WINDOWS) - 1)
    if settings.rollup:
        counts = rolling_counts(_refresh_rollup(spark, settings, targets, subjects), targets)
    elif len(targets) == 1:
        counts = unique_counts(_activity_log(spark, settings, reads), targets.last, subjects)
    else:
        counts = rolling_counts(daily_rollup(_activity_log(spark, settings, reads), subjects), targets)
    _write_unique(counts, f"{settings.results}/unique-stats", targets, _days(spark, settings, targets), subjects)


def _write_unique(counts: DataFrame, path: str, targets: Period, days: list[date], subjects: tuple[str, ...]) -> None:
    records = as_unique_stats(counts, targets).withColumn("kind", F.col("_type"))
    _write_records(records, path, days, tuple(f"{subject}{w}d-nodev" for subject in subjects for w in WINDOWS))


def unique_user(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Active users over trailing windows."""
    _activity(spark, settings, targets, ("user",))


def unique_class(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Active classes over trailing windows."""
    _activity(spark, settings, targets, ("class",))


def unique_all(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Active users and active classes from one scan."""
    _activity(spark, settings, targets, SUBJECTS)


def unique_all_devices(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Active users and classes with all devices and grades counted together, in a table of their own."""
    reads = targets.widen(before=max(WINDOWS) - 1)
    if settings.rollup:
        daily = _refresh_rollup(spark, settings, targets, SUBJECTS)
    else:
        daily = daily_rollup(_activity_log(spark, settings, reads), SUBJECTS)
    counts = rolling_counts(without_device(daily), targets)
    _write_unique(counts, f"{settings.results}/unique-stats-all-devices", targets, _days(spark, settings, targets), SUBJECTS)


def _lifecycle(spark: SparkSession, settings: Settings, targets: Period, kinds: tuple[str, ...]) -> None:
    events = lifecycle(_lifecycle_log(spark, settings, targets), kinds, settings.endpoints)
    records = as_accum_stats(events, targets)
    _write_records(records, f"{settings.results}/accum-stats", _days(spark, settings, targets), kinds)


def accum_user(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Sign-ups and account deletions."""
    _lifecycle(spark, settings, targets, ("user", "user-del"))


def accum_class(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Class creations and deletions."""
    _lifecycle(spark, settings, targets, ("class", "class-del"))


def accum_all(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Sign-ups, account deletions, class creations and class deletions from one scan."""
    _lifecycle(spark, settings, targets, KINDS)


def cohort(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Retention of sign-ups. By default sign-ups and activity come from the same 30 days."""
    signup_days = MONTH_BEFORE if settings.prior_signups else LAST_MONTH
    marked = _marked(spark, settings, reach_of(targets, signup_days, [LAST_MONTH]))
    records = as_cohort(retention_by_day(marked, targets, signup_days, LAST_MONTH))
    _write_records(records, f"{settings.results}/cohort", _days(spark, settings, targets))


def curve(spark: SparkSession, settings: Settings, targets: Period) -> None:
    """Retention month by month: `lags` windows of 30 days that end before the target day, after 30 days of sign-ups."""
    days = _days(spark, settings, targets)
    if not days:
        return
    reach = targets.widen(before=MONTH * (settings.lags + 1), after=-1)
    found = curve_by_day(_marked(spark, settings, reach), targets, MONTH, settings.lags)
    _write_records(found.withColumn("date", day_text(F.col("date"))), f"{settings.results}/cohort-curve", days)


JOBS = {
    "columnar-log": columnar_log,
    "archive": archive,
    "unique-user": unique_user,
    "unique-class": unique_class,
    "unique-all": unique_all,
    "unique-all-devices": unique_all_devices,
    "accum-user": accum_user,
    "accum-class": accum_class,
    "accum-all": accum_all,
    "cohort": cohort,
    "cohort-curve": curve,
}
# These tell sign-ups and deletions by the addresses of the service.
BY_ENDPOINT = ("accum-user", "accum-class", "accum-all", "cohort", "cohort-curve")


def run(spark: SparkSession, job: str, targets: Period, settings: Settings) -> None:
    if len(targets):
        with checkpoints(spark, settings.out):
            JOBS[job](spark, settings, targets)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one job over a period.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("start", help="last target day, yyyyMMdd")
    parser.add_argument("num_days", nargs="?", default="1", help="number of target days, counted back from START")
    parser.add_argument("--to", help="other end of the run period, instead of NUM_DAYS")
    parser.add_argument("--logs", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--log-format", choices=("json", "parquet"), default="json")
    parser.add_argument("--file-glob", help="sample: read only matching files, e.g. '*-10_*.gz'; results go to OUT/sample")
    parser.add_argument(
        "--allow-missing",
        action="store_true",
        help="go on if the log lacks a day that is read; target days it lacks keep what is stored",
    )
    parser.add_argument("--rollup", help="keep daily counts here, so that later runs scan new days only")
    parser.add_argument("--late-days", type=int, default=0, help="archive: also read this many later days")
    parser.add_argument("--prior-signups", action="store_true", help="cohort: sign-ups from the month before")
    parser.add_argument("--lags", type=int, default=Settings.lags, help="cohort-curve: months after the sign-ups")
    parser.add_argument("--www", help="address of the service; needed by " + ", ".join(BY_ENDPOINT))
    parser.add_argument("--oauth", help="address of its sign-in; needed by the same")
    parser.add_argument("--quality", action="store_true", help="print malformed lines and bad grades of every day that is read")
    parser.add_argument("--max-malformed", type=float, help="fail, with nothing written, if a larger share of a day's lines is malformed")
    args = parser.parse_args(argv)
    if args.job in BY_ENDPOINT and not (args.www and args.oauth):
        parser.error(f"{args.job} needs --www and --oauth")
    if args.file_glob and (args.rollup or args.log_format != "json"):
        parser.error("--file-glob goes with JSON logs and without --rollup")
    settings = Settings(
        logs=args.logs,
        out=args.out,
        log_format=args.log_format,
        file_glob=args.file_glob,
        allow_missing=args.allow_missing,
        rollup=args.rollup,
        late_days=args.late_days,
        prior_signups=args.prior_signups,
        lags=args.lags,
        quality=args.quality,
        max_malformed=args.max_malformed,
        endpoints=Endpoints(args.www or Endpoints.www, args.oauth or Endpoints.oauth),
    )
    targets = span(args.start, args.to) if args.to else run_period(args.start, args.num_days)
    spark = (
        SparkSession.builder.appName(f"daytally-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run(spark, args.job, targets, settings)
