"""Inputs shared by the registered queries, and the registry itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import columns as E
from tidelog.operators import context as C
from tidelog.operators import statements as T
from tidelog.plans import track as H
from tidelog.session import tune
from tidelog.sources.shared import written
from registry import sample_log as L

WIDTH = 50_000  # order values per range: two ranges at sf0.01, so carrying is exercised
ALLOW = L.ALLOW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Log:
    """The change log of one data folder, each step built when asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def raw(self) -> DataFrame:
        return L.raw_log(self.table("events"))

    @property
    def cells(self) -> DataFrame:
        return L.cell_table(self.table("events"))

    @property
    def meta(self) -> DataFrame:
        return L.table_meta(self.spark)

    @property
    def meta_now(self) -> DataFrame:
        # Written, so that its measured size decides how it is joined: a list has none, and cells
        # would be placed by their table, which are few.
        return written(L.current_meta(self.meta), "meta")

    @property
    def events(self) -> DataFrame:
        """Every event with its log file."""
        return C.attach_logfile(self.raw, WIDTH)

    @property
    def resolved(self) -> DataFrame:
        """Rows events with log file and table or error."""
        return C.resolved_events(self.raw, WIDTH).filter(C.is_rows_event())

    @property
    def statements(self) -> DataFrame:
        return T.classify_statements(self.events)

    @property
    def entries(self) -> DataFrame:
        return H.all_entries(self.raw, width=WIDTH)

    @property
    def numbered(self) -> DataFrame:
        """Kept entries (listed tables and markers) with their ids."""
        return H.kept_entries(self.raw, ALLOW, markers="keep", width=WIDTH)

    @property
    def owned(self) -> DataFrame:
        return E.attach_table(self.cells, self.resolved)

    @property
    def rendered(self) -> DataFrame:
        return E.render_cells(E.enrich_columns(self.owned, self.meta_now))

    @property
    def flagged(self) -> DataFrame:
        return E.flag_updated(self.rendered)

    @property
    def nested(self) -> DataFrame:
        """Row entries with nested before and after columns."""
        resolved = written(self.resolved, "resolved")  # for the cells and for the headers
        rendered = E.render_cells(E.enrich_columns(E.attach_table(self.cells, resolved), self.meta_now))
        shaped = E.flag_updated(rendered).withColumns({
            "is_null": F.col("value").isNull(), "mysql_type": F.col("column_type")})
        return E.assemble_entries(shaped, C.row_entries(resolved))

    @property
    def master(self) -> DataFrame:
        """Newest position of each server."""
        return newest(self.events)

    @property
    def log_index(self) -> DataFrame:
        return self.events.groupBy("server_id", "logfile").agg(
            F.min(F.col("log_pos") - F.col("event_len")).alias("first_pos"),
            F.max("log_pos").alias("last_pos"))


def newest(events: DataFrame) -> DataFrame:
    """server_id, logfile, pos of each server's last event."""
    at = F.max(F.struct("seq", "logfile", "log_pos")).alias("m")
    return events.groupBy("server_id").agg(at).select(
        "server_id", F.col("m.logfile").alias("logfile"), F.col("m.log_pos").alias("pos"))


def register(name: str, oracle: str | None = None):
    """Register a query given as a function of the log, with its SQL."""
    def add(build: Callable[[Log], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Log(tune(spark), folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return build
    return add
