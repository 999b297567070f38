"""Registry of queries over the test tables, and the frames they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality_rules
from ..operators.access import user_plant_map
from ..plans import clean, dashboard, marts, semantic
from ..session import configure, scratch_path, size_shuffles, stored, together
from ..sources.csv_source import RAW_FILES
from ..sources.lake import CODEC
from . import fixtures
from .oracle import with_ctes

# Total orders that stand in for the arrival position of a file.
RUN_ORDER = ("run_start_datetime", "machine_id", "product_id", "input_quantity",
             "seq_a", "seq_b", "seq_c", "seq_d", "seq_e")
QMS_ORDER = ("inspection_datetime", "product_id", "sample_size", "defect_count",
             "seq_a", "seq_b", "seq_c", "seq_d", "seq_e")
ROW_ORDER = {
    "work_order": ("work_order_id",),
    "production_run": ("run_id",),
    "quality_inspection": ("inspection_id",),
    "sensor_reading": ("machine_id", "timestamp"),
}
EXPORT_ORDER = {
    "work_order": ("load_timestamp",), "production_run": RUN_ORDER, "quality_inspection": QMS_ORDER,
    "sensor_reading": ("seq",),
}
EXPORT_RECORDS = 500_000  # of a compressed export file
CORE_TABLES = ("work_order", "production_run", "quality_inspection", "sensor_reading")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Shop:
    """Lazy factory frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._base: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        if table not in self._base:
            self._base[table] = fixtures.base(self.spark, self.sf_dir, table)
        return self._base[table]

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = fixtures.entity(name, self.base)
        return self._raw[name]

    @cached_property
    def work_orders(self) -> DataFrame:
        return clean.work_orders(self.raw("work_order"))

    @cached_property
    def runs(self) -> DataFrame:
        return clean.production_runs(self.raw("production_run"), order=RUN_ORDER)

    @cached_property
    def inspections(self) -> DataFrame:
        return clean.quality_inspections(self.raw("quality_inspection"), order=QMS_ORDER)

    @cached_property
    def sensors(self) -> DataFrame:
        return clean.sensor_readings(self.raw("sensor_reading"), order=("seq",))

    @cached_property
    def states(self) -> DataFrame:
        return clean.machine_state_events(self.raw("machine_state_event"))

    @cached_property
    def shipments(self) -> DataFrame:
        return clean.shipments(self.raw("shipment"))

    @cached_property
    def sales_orders(self) -> DataFrame:
        return clean.sales_orders(self.raw("sales_order"))

    @cached_property
    def oee(self) -> DataFrame:
        return marts.oee_daily_line(self.runs, self.work_orders)

    @cached_property
    def quality(self) -> DataFrame:
        return marts.quality_daily(self.inspections, self.work_orders, self.raw("product_master"))

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.sensor_hourly(self.sensors)

    @cached_property
    def delivery(self) -> DataFrame:
        return marts.delivery_order(self.sales_orders, self.shipments)

    @cached_property
    def features(self) -> DataFrame:
        return self.features_with()

    def features_with(self, *carry: str) -> DataFrame:
        """The feature table from written clean tables, whose joins read both sides twice."""
        return self.features_from(
            self.kept(self.runs.select(*marts.FEATURE_RUNS, *carry), "runs"),
            self.kept(self.inspections.select(*marts.FEATURE_INSPECTIONS), "inspections"), self.work_orders, carry)

    def features_from(
        self, runs: DataFrame, inspections: DataFrame, work_orders: DataFrame, carry: Sequence[str] = (),
    ) -> DataFrame:
        return marts.quality_features(
            runs, work_orders, self.raw("product_master"), self.raw("machine_master"), inspections, self.hourly, carry,
            step=self.step)

    def step(self, df: DataFrame, label: str = "step") -> DataFrame:
        """What a step of a plan hands on, written to the shared folder and read back."""
        return stored(df, label, codec=CODEC)

    def kept(self, df: DataFrame, label: str) -> DataFrame:
        """Written to the shared folder and read back, as the refresh does with clean tables."""
        path = self.scratch(label)
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def kpis(self, stamp: bool = True) -> DataFrame:
        """Executive row over written clean tables, narrow as its parts need them, one part after the other."""
        runs = self.kept(self.runs.select(*marts.OEE_RUNS), "runs")
        orders = self.kept(self.work_orders.select("work_order_id", "plant_id", "line_id"), "work-orders")
        inspections = self.kept(self.inspections.select(*marts.QUALITY_INSPECTIONS), "inspections")
        return dashboard.kpi_row(
            orders, runs, marts.oee_daily_line(runs, orders), self.issue_counts,
            marts.quality_daily(inspections, orders, self.raw("product_master")), self.delivery,
            stamp=stamp, step=self.step)

    @cached_property
    def core_raw(self) -> dict[str, DataFrame]:
        return {t: self.raw(t) for t in CORE_TABLES}

    @cached_property
    def issue_counts(self) -> DataFrame:
        return quality_rules.issue_counts(self.core_raw)

    @cached_property
    def user_plants(self) -> DataFrame:
        return user_plant_map(self.raw("plant_master"))

    def dataset(self, name: str) -> DataFrame:
        view, mart = {
            semantic.OEE: ("v_dataset_oee_operational", "oee"),
            semantic.QUALITY: ("v_dataset_quality_decision", "quality"),
            semantic.SENSOR: ("v_dataset_sensor_hourly", "hourly"),
            semantic.GOVERNANCE: ("v_dataset_dq_governance", "issue_counts"),
        }[name]
        return dashboard.dataset_view(view, getattr(self, mart))

    @cached_property
    def datasets(self) -> dict[str, DataFrame]:
        names = (semantic.OEE, semantic.QUALITY, semantic.SENSOR, semantic.GOVERNANCE)
        return {n: self.dataset(n) for n in names}

    def chart_source(self, chart: str) -> dict[str, DataFrame]:
        name = next(c.dataset_name for c in semantic.CHARTS if c.chart_name == chart)
        return {name: self.dataset(name)}

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def export_csv(
        self, name: str, path: str, headers: Callable[[str], str] = lambda c: c, order: Sequence[str] = (),
    ) -> None:
        """Write an entity the way an exporting system would, in ``order`` if it names columns."""
        df = self.raw(name).orderBy(*order) if order else self.raw(name)
        (df.toDF(*[headers(c) for c in df.columns]).write
           .option("header", True).option("escape", '"')
           .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .option("compression", "gzip").option("maxRecordsPerFile", EXPORT_RECORDS)  # one task reads a file whole
           .option("zlib.compress.level", "BEST_SPEED")  # read once or twice, so time counts more than size
           .csv(path))

    def export_all(self, ordered: bool = False) -> tuple[str, dict[str, str]]:
        """Every entity as CSV under its export path; returns folder and file map.

        ``ordered`` exports stand in the order that decides which duplicate is the last.
        """
        root, files = self.scratch("exports"), dict(self.export_files)
        self.each_export(lambda table, relative: self.export_csv(
            table, f"{root}/{relative}", order=EXPORT_ORDER.get(table, ()) if ordered else ()))
        return root, files

    @property
    def export_files(self) -> dict[str, str]:
        return {t: f for t, f in RAW_FILES.items() if t in fixtures.ENTITIES}

    def each_export(self, one: Callable[[str, str], DataFrame | None], parallel: int = 8) -> list:
        """``one(table, relative path)`` for every export, a few at a time."""
        for table in self.export_files:
            self.raw(table)  # made by this thread
        return together(self.spark, lambda item: one(*item), self.export_files.items(), parallel)


def plain(df: DataFrame) -> DataFrame:
    """Zone-less timestamps, as the base tables have them."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
        for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df


def query(name: str, oracle: str | None = None):
    """Register ``fn(shop)`` under ``name`` with its reference SQL."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            size_shuffles(spark, sf_dir, "*.parquet")
            return plain(fn(Shop(spark, sf_dir)))

        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__, run.__doc__ = name, fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = with_ctes(oracle)
        return fn

    return register


def all_queries():
    return dict(_QUERIES)


def all_oracles():
    return dict(_ORACLES)
