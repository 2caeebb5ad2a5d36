"""One daily run, as plain calls in layer order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskmart.operators.cleaning import DEFAULT_HORIZON, Horizon, clean
from riskmart.operators.mart import fraud_dashboard
from riskmart.operators.staging import stage
from riskmart.plans import incremental
from riskmart.session import side_by_side
from riskmart.sinks.serving import SERVING_SCHEMA, JdbcTarget, ParquetTarget, VersionedTarget, publish, wide_schema
from riskmart.sinks.tables import analyze_partitions, partition_rows, read_clean, register_folder, write_layer, write_months
from riskmart.sinks.versions import CommitLog, VersionedFolder
from riskmart.sources.messages import FileLog, KafkaLog
from riskmart.sources.raw import raw_path, raw_scan, replace_raw_view
from riskmart.specs import MONTH, SPECS, TableSpec
from riskmart.streaming.ingest import IngestReport, ingest_all

Bounds = tuple[Horizon, dt.date | None]


@dataclass(frozen=True)
class DailyConfig:
    """Where a run reads and writes, and the dates its rules use.

    ``bounds`` overrides horizon and as-of date per table. ``catalog`` is the name prefix under which a run
    registers its layers and collects their statistics; without it the layers stay plain folders.

    Every layer a run writes in full goes to a new version and is switched to afterwards, so a failed run leaves the
    old rows readable. ``incremental`` takes in new raw files and rewrites changed months only, see
    :mod:`riskmart.plans.incremental`; keep to one way per root folder.
    """

    log: KafkaLog | FileLog
    root: str
    target: ParquetTarget | VersionedTarget | JdbcTarget
    as_of: dt.date | None = None
    horizon: Horizon = DEFAULT_HORIZON
    bounds: Mapping[str, Bounds] = field(default_factory=dict)
    wide_ids: bool = False
    on_bad: str = "error"
    null_policy: str = "zero"
    publish_mode: str = "overwrite"
    catalog: str | None = None
    incremental: bool = False

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    def folder(self, layer: str, name: str) -> VersionedFolder:
        return VersionedFolder(f"{self.layer(layer)}/{name}")

    def specs(self) -> dict[str, TableSpec]:
        return {n: s.wide() if self.wide_ids else s for n, s in SPECS.items()}

    def dates(self, name: str) -> Bounds:
        return self.bounds.get(name, (self.horizon, self.as_of))

    def grows(self, spec: TableSpec) -> bool:
        """Whether the clean layer of the table is kept up to date by months instead of by versions."""
        return self.incremental and spec.has_event_time


def load_staging(spark: SparkSession, config: DailyConfig) -> None:
    """Typing keeps the partitions of the scan: event tables are written without a shuffle (by month if incremental)."""

    def load(spec: TableSpec) -> None:
        path = raw_path(config.layer("raw"), spec)
        if config.incremental:
            checkpoint = f"{config.layer('marks')}/stage/{spec.name}"
            incremental.stage_increment(spark, spec, path, f"{config.layer('ods')}/{spec.name}", checkpoint, config.on_bad)
            return
        folder = config.folder("ods", spec.name)
        folder.replace(spark, lambda new: write_layer(stage(raw_scan(spark, spec, path), spec, config.on_bad), new))
        folder.expire(spark)

    side_by_side(spark, load, config.specs().values())


def load_clean(spark: SparkSession, config: DailyConfig) -> dict[str, list[str] | None]:
    """Months written per table; None where all of a table was."""

    def load(spec: TableSpec) -> list[str] | None:
        horizon, as_of = config.dates(spec.name)
        ods, folder = f"{config.layer('ods')}/{spec.name}", config.folder("dds", spec.name)
        if config.grows(spec):
            marks = CommitLog(f"{config.layer('marks')}/clean/{spec.name}")
            return incremental.clean_increment(spark, spec, ods, folder.path, marks, as_of, horizon)
        if config.incremental:
            incremental.clean_keyed(spark, spec, ods, folder, as_of)
        else:
            staged = config.folder("ods", spec.name).read(spark, spec.typed_schema)
            folder.replace(spark, lambda new: write_months(clean(staged, spec, as_of, horizon), spec, new))
            folder.expire(spark)
        return None

    specs = config.specs()
    return dict(zip(specs, side_by_side(spark, load, specs.values()), strict=True))


def clean_layer(spark: SparkSession, config: DailyConfig, name: str) -> DataFrame:
    spec, folder = config.specs()[name], config.folder("dds", name)
    if config.grows(spec):
        return read_clean(spark, spec, folder.path)
    return folder.read(spark, spec.clean_schema)


def load_mart(spark: SparkSession, config: DailyConfig) -> None:
    tables = {name: clean_layer(spark, config, name) for name in ("clients", "transactions", "logins")}
    folder = config.folder("dm", "fraud_dashboard")
    folder.replace(spark, lambda new: write_layer(fraud_dashboard(**tables), new))
    folder.expire(spark)


def publish_mart(spark: SparkSession, config: DailyConfig) -> bool:
    mart = config.folder("dm", "fraud_dashboard").read(spark)
    schema = wide_schema() if config.wide_ids else SERVING_SCHEMA
    return publish(mart, config.target, config.publish_mode, config.null_policy, schema)


def register_layers(
    spark: SparkSession,
    config: DailyConfig,
    prefix: str = "",
    statistics: bool = True,
    months: Mapping[str, list[str] | None] | None = None,
) -> None:
    """Catalog names for all layers, for SQL users: ``<prefix>ods_*``, ``dds_*``, ``dm_fraud_dashboard``.

    Names are switched to the present version of a layer. Raw folders become session views, see
    :func:`replace_raw_view`. Of an incremental layer only the ``months`` just written are counted for statistics
    (where that is not known, those without any); typed increments are not read again at all.
    """
    for name, spec in config.specs().items():
        replace_raw_view(spark, spec, raw_path(config.layer("raw"), spec), f"{prefix}raw_{name}")
        month = [MONTH] if spec.has_event_time else []
        if config.incremental:
            ods, parts = f"{config.layer('ods')}/{name}", incremental.staged_partitions(spec)
            register_folder(spark, f"{prefix}ods_{name}", incremental.staged_schema(spec), ods, *parts, statistics=False)
        else:
            (ods,) = config.folder("ods", name).folders(spark)
            register_folder(spark, f"{prefix}ods_{name}", spec.typed_schema, ods, statistics=statistics)
        dds = config.folder("dds", name)
        location = dds.path if config.grows(spec) else dds.folders(spark)[0]
        grows = config.grows(spec)
        register_folder(spark, f"{prefix}dds_{name}", spec.clean_schema, location, *month, statistics=statistics and not grows)
        if statistics and grows:
            known = partition_rows(spark, f"{prefix}dds_{name}", MONTH)
            written = (months or {}).get(name)
            fresh = set(known if months and written is None else written or ())
            missing = {m for m, n in known.items() if n is None}
            analyze_partitions(spark, f"{prefix}dds_{name}", MONTH, sorted((fresh | missing) & set(known)))
    (mart,) = config.folder("dm", "fraud_dashboard").folders(spark)
    register_folder(spark, f"{prefix}dm_fraud_dashboard", spark.read.parquet(mart).schema, mart, statistics=statistics)


def run_daily(spark: SparkSession, config: DailyConfig) -> dict[str, IngestReport]:
    """Ingest new messages, then refresh staging, clean layer and mart, then publish."""
    reports = ingest_all(spark, config.log, config.specs().values(), config.layer("raw"))
    load_staging(spark, config)
    months = load_clean(spark, config)
    load_mart(spark, config)
    if config.catalog is not None:
        register_layers(spark, config, config.catalog, months=months)
    publish_mart(spark, config)
    return reports
