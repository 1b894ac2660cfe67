"""The full run: manifest -> bronze -> silver -> cubes -> gold -> checks -> export.

Each layer is written to the run's folder and read back, so a lost executor
costs a task retry over files, never a recomputation from raw. Silver is read
once per cube; gold and all export sections come from the cubes.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, fields
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marlstone.config import PARTITION_COLUMNS, FeedConfig
from marlstone.operators import exports, gold, quality
from marlstone.operators.gold import INCIDENTS, TOTAL
from marlstone.operators.joins import measured_bytes
from marlstone.operators.silver import annotate, candidates, code_dimension, dedupe_keys, rejects, with_key_hash
from marlstone.operators.silver import silver as silver_rows
from marlstone.plans import incremental
from marlstone.sources import bronze as bronze_layer
from marlstone.sources import manifest as manifests
from marlstone.sources import sinks
from marlstone.sources.readers import read_source, reference_codes


WRITERS = 8  # independent output tables written at the same time
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024
SCAN_TARGET_ROWS = 250_000  # a few seconds of typing


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables; ``root`` must be visible to every executor."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))


@dataclass(frozen=True)
class Cubes:
    by_time: DataFrame
    by_station: DataFrame
    by_code: DataFrame


@dataclass(frozen=True)
class RunResult:
    silver: DataFrame
    rejects: DataFrame
    cubes: Cubes
    checks: list[quality.CheckResult]
    report: dict


GOLD_MODELS: dict[str, Callable[[Cubes], DataFrame]] = {
    "daily_summary": lambda c: gold.daily_summary(c.by_station),
    "monthly_trend": lambda c: gold.monthly_trend(c.by_time),
    "delays_by_hour": lambda c: gold.delays_by_hour(c.by_time),
    "delays_by_line": lambda c: gold.delays_by_line(c.by_time),
    "delays_by_station": lambda c: gold.delays_by_station(c.by_station),
    "delays_by_code": lambda c: gold.delays_by_code(c.by_code),
}


def silver_cubes(silver: DataFrame) -> Cubes:
    """Cubes by month: each month's cells come from its own rows, so that a month can be replaced."""
    if not set(PARTITION_COLUMNS) <= set(silver.columns):
        silver = sinks.with_months(silver)
    return Cubes(*[cube(silver, PARTITION_COLUMNS) for cube in (gold.time_cube, gold.station_cube, gold.code_cube)])


def cube_counts(cubes: Cubes) -> dict[str, DataFrame]:
    """(value, rows) by column of silver, summed from the cubes."""
    sources = {"code_clean": cubes.by_code, "station": cubes.by_station, "event_year_month": cubes.by_time}
    return {column: cube.groupBy(F.col(column).alias("_value")).agg(F.sum(INCIDENTS).alias("_rows"))
            for column, cube in sources.items()}


@contextmanager
def sized_shuffles(spark: SparkSession, raw_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions that one holds about SHUFFLE_TARGET_BYTES of raw data.

    Only ever raises the session's setting; adaptive execution merges what
    turns out small.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    wanted = -(-raw_bytes // SHUFFLE_TARGET_BYTES)
    spark.conf.set(setting, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


SCAN_TASKS = "spark.sql.files.minPartitionNum"


@contextmanager
def restored(spark: SparkSession, setting: str) -> Iterator[None]:
    """The session's ``setting`` as it is now, or unset, whatever becomes of it inside."""
    before = spark.conf.get(setting, None)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def size_scans(spark: SparkSession, rows: int) -> None:
    """Scans of the layers in enough tasks that one reads about SCAN_TARGET_ROWS.

    Spark packs files into tasks by their bytes, and a layer's files are small for
    their rows: one task would take all files of a month with many rows. Only ever
    raises the session's setting.
    """
    least = int(spark.conf.get(SCAN_TASKS, None) or spark.sparkContext.defaultParallelism)
    spark.conf.set(SCAN_TASKS, str(max(least, -(-rows // SCAN_TARGET_ROWS))))


_SIZE = re.compile(r"Statistics\(sizeInBytes=([\d.E+]+) ([KMGTPE]?i?B)")
_UNITS = {unit: 1024 ** i for i, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}
UNKNOWN_BYTES = 2 ** 62  # what the optimizer assumes of data it knows nothing of is larger


def table_bytes(spark: SparkSession, cfg: FeedConfig) -> int:
    """Size of the sources that are catalog tables or views.

    That is the sum over the relations a view reads, not the optimizer's product
    for its joins. Where a relation's size is not known, the view is measured.
    """
    names = [s.path for s in (*cfg.sources, *([cfg.codes] if cfg.codes else [])) if s.format == "table"]
    return sum(_relation_bytes(spark, name) for name in names)


def _relation_bytes(spark: SparkSession, name: str) -> int:
    lines = spark.sql(f"EXPLAIN COST SELECT * FROM {name}").first()[0].split("== Physical Plan ==")[0].splitlines()
    plan = [(re.search(r"[A-Za-z]", line).start(), _SIZE.search(line)) for line in lines if _SIZE.search(line)]
    # a node is a leaf where the next line is not below it
    leaves = [found for (depth, found), (after, _) in zip(plan, [*plan[1:], (0, None)], strict=True) if after <= depth]
    sizes = [float(found[1]) * _UNITS[found[2]] for found in leaves]
    return int(sum(sizes)) if sizes and max(sizes) < UNKNOWN_BYTES else measured_bytes(spark.table(name))


# --- steps ------------------------------------------------------------------

def update_manifest(
    spark: SparkSession, cfg: FeedConfig, layout: Layout, run_id: str,
) -> tuple[DataFrame, DataFrame]:
    """This run's manifest rows, compared with the run before and kept with it; and that run's."""
    path = layout.path("manifest")
    nothing = manifests.empty_manifest(spark).withColumn("run_id", F.lit(run_id))
    nothing.write.mode("ignore").parquet(path)  # first run only
    history = spark.read.schema(nothing.schema).parquet(path)
    last = history.agg(F.max("run_id")).first()[0]
    previous = history.where(F.col("run_id") == last)

    specs = [*cfg.sources, *([cfg.codes] if cfg.codes else [])]
    files = {s.name: s.path for s in specs if s.format != "table"}
    if files:
        rows = manifests.compare(manifests.scan_files(spark, files), previous)
        rows.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
    history = spark.read.schema(nothing.schema).parquet(path)
    return history.where(F.col("run_id") == run_id), history.where(F.col("run_id") == last)


def unchanged(current: DataFrame, previous: DataFrame) -> bool:
    return manifests.changed_files(current).isEmpty() and manifests.gone_files(current, previous).isEmpty()


def build_bronze(spark: SparkSession, cfg: FeedConfig, layout: Layout) -> tuple[DataFrame, int]:
    """Write this batch's partitions; return exactly them and their number of rows.

    Partitions of earlier batches survive in the table; the months and rows of
    this batch are observed during the write, so reading back needs no extra pass.
    """
    batch = bronze_layer.read_bronze_sources(spark, cfg)
    seen = Observation("bronze_months")
    month = F.struct("partition_year", "partition_month")
    sinks.write_partitioned(
        batch.observe(seen, F.collect_set(month).alias("months"), F.count(F.lit(1)).alias("rows")), layout.path("bronze"),
        gather=not cfg.time_ordered)
    stored = spark.read.schema(batch.schema).parquet(layout.path("bronze"))
    return stored.where(incremental.in_months([(m[0], m[1]) for m in seen.get["months"]])), seen.get["rows"]


def typed_table(rows: DataFrame, codes: DataFrame, cfg: FeedConfig, layout: Layout) -> DataFrame:
    """Typed rows with the hash of their key, stored until silver is made."""
    path = layout.path("work", "typed")
    typed = with_key_hash(annotate(rows, code_dimension(codes), cfg), dedupe_keys(cfg))
    sinks.write_partitioned(typed, path, ("is_reject",), gather=False, replace=True)
    return rows.sparkSession.read.schema(typed.schema).parquet(path)


def store_silver(
    bronze: DataFrame, codes: DataFrame, cfg: FeedConfig, layout: Layout,
) -> tuple[DataFrame, DataFrame, int]:
    """Silver, rejects and silver's number of rows.

    Bronze is read and typed once; dedupe then reads one column of the typed
    rows, and the rows themselves are shuffled once, into their months. Rows
    without a timestamp are kept as they came, for runs that rebuild a few months.
    """
    spark = bronze.sparkSession
    typed = typed_table(bronze, codes, cfg, layout)
    rejected = rejects(typed)
    sinks.write_table(rejected, layout.path("silver", "rejects"))
    rows = Observation("silver_rows")
    sinks.write_silver(
        silver_rows(typed, cfg).observe(rows, F.count(F.lit(1)).alias("rows")), layout.path("silver", "delays"))
    if incremental.supported(cfg):
        sinks.write_table(incremental.untimed(candidates(typed, cfg)), layout.path("state", "untimed"))
        sinks.write_table(incremental.months_of_files(bronze), layout.path("state", "file_months"))
    sinks.remove(spark, layout.path("work"))
    return *stored_silver(spark, layout, rejected.schema), rows.get["rows"]


def update_months(
    spark: SparkSession, codes: DataFrame, cfg: FeedConfig, layout: Layout, change: incremental.Change,
) -> list[incremental.Month]:
    """Bronze, rejects, silver and cubes of the months that changed files touch; returns the months of silver.

    Reads the files with rows in those months, and nothing else of the raw feeds.
    """
    work = layout.path("work")
    batch = incremental.stored(incremental.read_files(spark, cfg, change.files), f"{work}/batch")
    of_months = batch.where(incremental.in_months(change.months))
    sinks.write_partitioned(of_months, layout.path("bronze"), gather=not cfg.time_ordered)
    typed = typed_table(batch, codes, cfg, layout)
    silver, rejected = stored_silver(spark, layout)
    touched = incremental.in_months(change.months)
    fresh = rejects(typed).where(touched)
    sinks.write_table(
        incremental.stored(rejected.where(~touched).unionByName(fresh), f"{work}/rejects"),
        layout.path("silver", "rejects"))
    rows, untimed, months = incremental.rebuilt_silver(
        typed, change, spark.read.parquet(layout.path("state", "untimed")), silver, cfg, work)
    incremental.replace_months(rows, layout.path("silver", "delays"), months, sinks.SILVER_ORDER)
    for name, cube in vars(silver_cubes(rows)).items():
        incremental.replace_months(
            incremental.stored(cube, f"{work}/cubes/{name}"), layout.path("cubes", name), months)
    sinks.write_table(untimed, layout.path("state", "untimed"))
    sinks.write_table(change.file_months, layout.path("state", "file_months"))
    sinks.remove(spark, work)
    return months


def stored_silver(spark: SparkSession, layout: Layout, rejects_schema=None) -> tuple[DataFrame, DataFrame]:
    reader = spark.read.schema(rejects_schema) if rejects_schema is not None else spark.read
    return (sinks.read_silver(spark, layout.path("silver", "delays")),
            reader.parquet(layout.path("silver", "rejects")))


def _write_all(write: Callable[[DataFrame, str], None], frames: dict[str, DataFrame]) -> None:
    """Independent writes a few at a time, so that small jobs share the cluster."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(write, df, path) for path, df in frames.items()]:
            done.result()


def _stored(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_cubes(silver: DataFrame, layout: Layout) -> Cubes:
    cubes = vars(silver_cubes(silver))
    paths = {name: layout.path("cubes", name) for name in cubes}
    _write_all(partial(sinks.write_partitioned, replace=True), {paths[name]: cube for name, cube in cubes.items()})
    return Cubes(**{name: _stored(cube, paths[name]) for name, cube in cubes.items()})


def stored_cubes(spark: SparkSession, layout: Layout) -> Cubes:
    return Cubes(**{f.name: spark.read.parquet(layout.path("cubes", f.name)) for f in fields(Cubes)})


def materialise_gold(cubes: Cubes, layout: Layout) -> None:
    _write_all(sinks.write_table, {
        layout.path("gold", name): model(cubes) for name, model in GOLD_MODELS.items()})


def publish(cubes: Cubes, cfg: FeedConfig, layout: Layout) -> None:
    """One JSON-lines dataset per export section; shared rankings are stored first."""
    def keep(name: str, df: DataFrame) -> DataFrame:
        path = layout.path("rankings", name)
        sinks.write_table(df, path)
        return _stored(df, path)

    parts = exports.sections(
        cubes.by_time, cubes.by_station, cubes.by_code, cfg.line_codes, keep)
    _write_all(sinks.write_json, {
        layout.path("export", name): rows for name, rows in parts.items()})


def reconcile(cubes: Cubes) -> DataFrame:
    """One row: do all breakdowns add up to the headline?"""
    daily = gold.line_days(cubes.by_time).select(F.lit(None).cast("bigint").alias(INCIDENTS), TOTAL)
    views = [
        gold.headline(cubes.by_station), gold.line_totals(cubes.by_station, "year"),
        gold.line_totals(cubes.by_station, "quarter"), gold.line_hours(cubes.by_time, "year"),
        gold.line_hours(cubes.by_time, "quarter"), gold.line_months(cubes.by_time),
        gold.day_summary(cubes.by_station), gold.code_totals(cubes.by_code, "year"), daily,
    ]
    sums = [v.agg(F.sum(INCIDENTS).alias(INCIDENTS), F.sum(TOTAL).alias(TOTAL)) for v in views]
    together = reduce(lambda a, b: a.unionByName(b), sums)
    return together.agg(
        F.max(INCIDENTS).alias(INCIDENTS), F.max(TOTAL).alias(TOTAL),
        (F.min(INCIDENTS) == F.max(INCIDENTS)).alias("incidents_agree"),
        (F.min(TOTAL) == F.max(TOTAL)).alias("totals_agree"),
    )


def run_report(
    spark: SparkSession, started: dt.datetime, manifest: DataFrame, counts: dict,
    checks: list[quality.CheckResult],
) -> dict:
    """What ran and how it went; the manifest itself stays a table, summed per source."""
    files = manifest.groupBy("logical_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.count_if(F.col("status") != "unchanged_skipped").alias("changed"),
    ).orderBy("logical_name")
    return {
        "run_started_utc": started.isoformat(),
        "run_finished_utc": dt.datetime.now(dt.timezone.utc).isoformat(),
        "manifest_files": [r.asDict() for r in files.collect()],
        "row_counts": counts,
        "checks": [{**c.to_dict(), "measured": str(c.measured)} for c in checks],
        "checks_passed": sum(1 for c in checks if c.passed),
        "checks_total": len(checks),
    }


STATE_SCHEMA = "config string, columns string, bronze bigint, silver bigint"
REPORT_SCHEMA = (
    "run_started_utc string, run_finished_utc string, "
    "manifest_files array<struct<logical_name: string, files: bigint, bytes: bigint, changed: bigint>>, "
    "row_counts struct<bronze: bigint, silver: bigint, silver_rejects_or_duplicates_removed: bigint>, "
    "checks array<struct<name: string, layer: string, passed: boolean, measured: string, "
    "threshold: string, detail: string>>, checks_passed bigint, checks_total bigint"
)


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    return spark.createDataFrame([report], REPORT_SCHEMA)


def run(
    spark: SparkSession, cfg: FeedConfig, root: str,
    run_date: dt.date | None = None, gate: bool = False,
) -> RunResult:
    """Bring every layer up to date with the raw feeds; running it again changes nothing.

    Where no file has changed since a finished run of the same configuration, its
    layers are kept and only checks and report are made anew. Where some have,
    the months they touch are rebuilt, as a full run would make them; another
    configuration, code reference or set of columns rebuilds all. With ``gate`` a
    failed check stops the run after the report, before export.
    """
    layout = Layout(root)
    started = dt.datetime.now(dt.timezone.utc)
    manifest, previous = update_manifest(spark, cfg, layout, started.isoformat())
    raw_bytes = (manifest.agg(F.sum("bytes")).first()[0] or 0) + table_bytes(spark, cfg)
    with sized_shuffles(spark, raw_bytes), restored(spark, SCAN_TASKS):
        finished = finished_run(spark, cfg, layout)
        if not finished:
            way = "all"
        else:
            way = "none" if unchanged(manifest, previous) else "months"
        return _bring_up(spark, cfg, layout, started, manifest, previous, run_date, gate, finished, way)


def fingerprint(cfg: FeedConfig) -> str:
    return hashlib.sha256(repr(cfg).encode()).hexdigest()


def finished_run(spark: SparkSession, cfg: FeedConfig, layout: Layout) -> dict | None:
    """Row counts and columns of the last finished run, if its configuration was this one.

    A catalog table has no files in the manifest, so its feeds always run.
    """
    if not incremental.supported(cfg) or (cfg.codes and cfg.codes.format == "table"):
        return None
    path = layout.path("reports", "finished")
    state = spark.read.schema(STATE_SCHEMA).option("mode", "PERMISSIVE").json(path) if sinks.exists(spark, path) else None
    row = state.first() if state is not None else None
    return row.asDict() if row and row["config"] == fingerprint(cfg) else None


def _columns(bronze: DataFrame) -> str:
    return bronze.schema.simpleString()


def _months_alone(
    spark: SparkSession, cfg: FeedConfig, layout: Layout, manifest: DataFrame, previous: DataFrame, finished: dict,
) -> incremental.Change | None:
    """What is to be rebuilt, or None where only a full run will do."""
    if _columns(incremental.read_files(spark, cfg, [])) != finished["columns"]:
        return None
    file_months = spark.read.parquet(layout.path("state", "file_months"))
    return incremental.find_change(spark, cfg, manifest, previous, file_months, layout.path("work"))


def _bring_up(
    spark: SparkSession, cfg: FeedConfig, layout: Layout, started: dt.datetime, manifest: DataFrame,
    previous: DataFrame, run_date: dt.date | None, gate: bool, finished: dict | None, way: str,
) -> RunResult:
    codes = read_source(spark, cfg.codes)
    change = _months_alone(spark, cfg, layout, manifest, previous, finished) if way == "months" else None
    if way != "none":
        sinks.remove(spark, layout.path("reports", "finished"))
    if way == "none" or change:
        if change:
            size_scans(spark, change.file_months.agg(F.sum("rows")).first()[0] or 0)
            update_months(spark, codes, cfg, layout, change)
        file_months = spark.read.parquet(layout.path("state", "file_months"))
        bronze = spark.read.parquet(layout.path("bronze")).where(
            incremental.in_months(incremental.months_in(file_months)))
        silver, rejected = stored_silver(spark, layout)
        cubes = stored_cubes(spark, layout)
        n_bronze = file_months.agg(F.sum("rows")).first()[0] or 0
        size_scans(spark, n_bronze)
        n_silver = cubes.by_time.agg(F.sum(INCIDENTS)).first()[0] or 0
        columns = finished["columns"]
    else:
        bronze, n_bronze = build_bronze(spark, cfg, layout)
        size_scans(spark, n_bronze)
        silver, rejected, n_silver = store_silver(bronze, codes, cfg, layout)
        cubes = store_cubes(silver, layout)
        columns = _columns(bronze)
    if way != "none":
        materialise_gold(cubes, layout)
    sinks.publish_view(silver, cfg.view_name)

    checks = quality.run_preset(
        bronze, silver, reference_codes(codes), run_date or started.date(), cfg.thresholds,
        cube_counts(cubes))
    counts = {"bronze": n_bronze, "silver": n_silver, "silver_rejects_or_duplicates_removed": n_bronze - n_silver}
    report = run_report(spark, started, manifest, counts, checks)
    sinks.write_json(report_frame(spark, report), layout.path("reports", "latest_run"))
    if gate:
        quality.assert_passed(checks)
    if way != "none":
        publish(cubes, cfg, layout)
        state = spark.createDataFrame([(fingerprint(cfg), columns, n_bronze, n_silver)], STATE_SCHEMA)
        sinks.write_json(state, layout.path("reports", "finished"))
    return RunResult(silver, rejected, cubes, checks, report)
