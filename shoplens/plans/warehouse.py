"""The model chain: raw -> clean -> staging -> facts -> marts.

``Warehouse`` builds each layer lazily once per instance; a pipeline run
(``run``) materializes the shared facts to tables so the marts read files
instead of re-deriving the facts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property
import time

from pyspark.sql import DataFrame, SparkSession

from shoplens.plans import facts, ingest, marts, refresh, sketches, staging, versions
from shoplens.session import reliable
from shoplens.sources.fixture import raw_events_from_dir


class Warehouse:
    """Lazy layers over one data directory (the driver's parquet tables)."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_events_from_dir(self.spark, self.data_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return ingest.clean_events(self.raw)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_events(self.clean)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_events(self.stg)

    def share_fact(self) -> "Warehouse":
        """Checkpoint ``fact_events`` once (shared checkpoint folder) before
        deriving several layers from it in one query, so the fact chain is
        not recomputed per branch and a lost executor does not replay it."""
        self.__dict__["fact"] = reliable(self.fact)
        return self

    @cached_property
    def sessions(self) -> DataFrame:
        return facts.fact_sessions(self.fact)

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.funnel_daily(self.fact)

    @cached_property
    def retention(self) -> DataFrame:
        return marts.retention_cohort_weekly(self.fact)

    @cached_property
    def growth(self) -> DataFrame:
        return marts.category_growth_weekly(self.fact)

    @cached_property
    def rfm(self) -> DataFrame:
        return marts.rfm(self.fact)

    @cached_property
    def price_performance(self) -> DataFrame:
        return marts.price_performance(self.fact)

    @cached_property
    def product_matrix(self) -> DataFrame:
        return marts.product_matrix(self.fact)

    @cached_property
    def user_sketches(self) -> DataFrame:
        return sketches.daily_user_sketches(self.fact)


@dataclass(frozen=True)
class Layout:
    """How a layer is stored: one folder per date, rows of a file in an order
    that keeps a category's and a product's rows together (min/max of the row
    groups), and Bloom filters on the ids that are looked up."""
    folder: str | None = None
    order: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()


IDS = ("user_session", "user_id", "product_id")
LAYOUTS = {
    "clean": Layout("event_date", ("category_code", "product_id"), IDS),
    "fact": Layout("event_date", ("category_l1", "product_id"), IDS),
    "sessions": Layout("session_date", ("user_id",), ("user_session", "user_id")),
    "funnel": Layout("event_date"),
    "rfm": Layout(None, ("user_id",), ("user_id",)),
}


def materialize(df: DataFrame, path: str, folder: str | None = None,
                layout: Layout | None = None, **options) -> DataFrame:
    """Write a layer as Parquet (``store``) and read it back: later layers scan
    files (column pruning, filter pushdown) instead of re-deriving the plan, and
    the lineage is cut, so a lost executor never replays upstream work."""
    store(df, path, folder, layout, **options)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def store(df: DataFrame, path: str, folder: str | None = None,
          layout: Layout | None = None, **options) -> None:
    """Write a layer as Parquet.

    With a ``folder`` (or one in ``layout``) the table has one folder per
    date, so a date filter opens only those; files are sized by adaptive
    execution.  ``options`` go to the writer."""
    layout = layout or Layout(folder, tuple(c for c in ("user_id",) if folder and c in df.columns))
    keys = [c for c in (layout.folder, *layout.order) if c]
    rows = df.hint("rebalance", layout.folder) if layout.folder else df
    write = (rows.sortWithinPartitions(*keys) if keys else rows).write.mode("overwrite")
    write = write.option("partitionOverwriteMode", "static").option("compression", "zstd")
    if layout.bloom:
        write = write.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in layout.bloom:
        write = write.option(f"parquet.bloom.filter.enabled#{c}", "true")
    for key, value in options.items():
        write = write.option(key.replace("__", "."), value)
    (write.partitionBy(layout.folder) if layout.folder else write).parquet(path)


class MaterializedWarehouse(Warehouse):
    """A pipeline run: ingest to date-partitioned files, then the facts and
    marts as tables under ``out_dir`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, data_dir: str, out_dir: str, job_tag: str = "",
                 version_dir: str | None = None):
        super().__init__(spark, data_dir)
        self.out_dir = out_dir.rstrip("/")
        self.version_dir = version_dir or self.out_dir
        self.job_tag = job_tag      # prefix of the job descriptions of this run
        self.parts: dict[str, list[refresh.Part]] = {}     # of layers that are not one folder

    def _path(self, name: str) -> str:
        return f"{self.out_dir if name == 'events' else self.version_dir}/{name}"

    def folder_of(self, layer: str) -> str | None:
        """The folder of a layer; None if it is made of several parts."""
        parts = self.parts.get(layer) or [refresh.Part(self._path(layer))]
        return parts[0].path if len(parts) == 1 else None

    def run_ingest(self) -> None:
        ingest.write_partitioned(ingest.clean_events(self.raw), self._path("events"))
        self.__dict__["clean"] = ingest.read_partitioned(self.spark, self._path("events"))

    def build(self, layer: str) -> DataFrame:
        """Materialize one layer (``fact``, ``sessions``, ``funnel`` ...)."""
        if layer == "fact":
            # A stored layer of its own, so that a hot user can be split.
            first = materialize(facts.user_first_dates(self.stg), self._path("first_dates"))
            source = facts.fact_events(self.stg, first)
        else:
            source = getattr(self, layer)
        df = materialize(source, self._path(layer), layout=LAYOUTS.get(layer))
        self.__dict__[layer] = df
        return df

    def build_many(self, layers, threads: int = 4) -> dict[str, float]:
        """Materialize independent layers concurrently (one Spark job stream
        per thread, like a model runner with N threads); returns each
        layer's elapsed seconds."""
        def one(layer):
            # Own scheduler pool per model: with spark.scheduler.mode=FAIR the
            # concurrent models share executors instead of queueing FIFO.
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"model-{layer}")
            self.spark.sparkContext.setJobDescription(f"{self.job_tag}{layer}")
            t0 = time.perf_counter()
            self.build(layer)
            return layer, time.perf_counter() - t0
        with ThreadPoolExecutor(max_workers=threads) as pool:
            return dict(pool.map(one, layers))


MART_LAYERS = ("sessions", "funnel", "retention", "growth", "rfm", "price_performance",
               "product_matrix")


class CsvPipeline(MaterializedWarehouse):
    """The production flow over a folder of raw CSV files: incremental
    ingest to date-partitioned files, the typed staging table (optionally
    the first N dates), then facts and marts as tables under ``out_dir``."""

    def __init__(self, spark: SparkSession, raw_dir: str, out_dir: str,
                 sample_days: int | None = None, version_dir: str | None = None):
        super().__init__(spark, raw_dir, out_dir, version_dir=version_dir)
        self.sample_days = sample_days

    @cached_property
    def clean(self) -> DataFrame:
        events = ingest.read_partitioned(self.spark, self._path("events"))
        return ingest.staging_frame(ingest.first_partitions(events, self.sample_days))

    def reopen(self, version: dict, layers) -> None:
        """Use the tables of a published version."""
        for layer in layers:
            columns = (version["columns"] or {}).get(layer, ["*"])
            if layer in refresh.DATED:
                self.use_parts(layer, refresh.parts_of(version, layer), columns)
            else:
                self.__dict__[layer] = (self.spark.read.parquet(f"{version['path']}/{layer}")
                                        .select(*columns))

    def use_parts(self, layer: str, parts: list[refresh.Part], columns: list[str]) -> DataFrame:
        self.parts[layer] = parts
        whole = refresh.read_parts(self.spark, parts, refresh.DATED[layer])
        self.__dict__[layer] = whole.select(*columns)
        return self.__dict__[layer]

    def add_part(self, layer: str, rows: DataFrame, dates: list, before: list[refresh.Part]) -> DataFrame:
        """Write the rows of some dates; the layer is the parts before and these."""
        store(rows, self._path(layer), layout=LAYOUTS[layer])
        path = self._path(layer) if _has_data(self.spark, self._path(layer)) else None
        return self.use_parts(layer, [*before, refresh.Part(path, tuple(dates))], rows.columns)

    def refresh(self, version: dict, touched: list) -> bool:
        """Build the dated layers from those of ``version`` and the events of
        the dates that have changed since; False (and nothing is used of it)
        where building them anew is no dearer."""
        old = CsvPipeline(self.spark, self.data_dir, self.out_dir)
        old.reopen(version, refresh.DATED)
        if len(old.parts["fact"]) >= refresh.MAX_PARTS or not touched:
            return False
        # The sink below ``events`` holds the new state of every date.
        stg = staging.stg_events(self.clean)
        n_dates = self.clean.select("event_date").distinct().count()
        if len(touched) > refresh.MAX_SHARE * n_dates:
            return False
        old_first = self.spark.read.parquet(f"{version['path']}/first_dates")
        new_first = materialize(
            refresh.first_dates(old_first, old.fact, refresh.on_dates(stg, "event_date", touched), touched),
            self._path("first_dates"))
        tagged = refresh.dates_to_tag(old_first, new_first, old.fact, touched)
        if len(tagged) > refresh.MAX_SHARE * n_dates:
            return False
        self.add_part("clean", refresh.on_dates(self.clean, "event_date", touched), touched, old.parts["clean"])
        fact = facts.fact_events(refresh.on_dates(stg, "event_date", tagged), new_first)
        self.add_part("fact", fact, tagged, old.parts["fact"])
        funnel = marts.funnel_daily(refresh.on_dates(self.fact, "event_date", tagged))
        self.add_part("funnel", funnel, tagged, old.parts["funnel"])
        sessions, began = refresh.changed_sessions(old.sessions, old.fact, self.fact, touched, reliable)
        self.add_part("sessions", sessions, began, old.parts["sessions"])
        return True


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds readable Parquet data (missing folder or no
    files raise an AnalysisException when the schema is resolved)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def run_pipeline(spark: SparkSession, raw_dir: str, out_dir: str,
                 checkpoint_root: str | None = None, full_refresh: bool = False,
                 sample_weeks: int | None = None, sample_days: int | None = None,
                 threads: int = 4, check: str = "all", files_per_batch: int = 1,
                 mode: str = "replace", publish: bool = True, prefix: str = "",
                 rebuild: str = "touched", stream: bool = False) -> dict:
    """Ingest new raw files, rebuild staging, facts and marts, validate.

    With ``rebuild="touched"`` only the dates that changed since the current
    version are rewritten in the dated layers (``plans/refresh.py``; the rows
    are those of a full rebuild), ``"all"`` builds every layer anew.  A version
    whose files an earlier run took in without publishing them is made up for.
    With ``stream`` the files come as a stream (``streaming/arrivals.py``).

    Returns ``status`` (``success``, ``no_new_files`` if nothing had to be
    rebuilt, ``no_data``), ``files`` (statistics per file of this run),
    ``batches``, ``total_rows``, ``tables`` (the Parquet folder of each layer
    under ``out_dir``, a shared folder on a cluster; None for a layer of
    several parts, which its view or the ``warehouse`` reads), ``names``
    (catalog views), ``version``, ``rebuilt`` (``all``, ``touched`` or
    ``nothing``), ``seconds`` and ``checks``.

    The layers are written as a new version and published together when all
    are whole: until then, and if the run dies, readers see the one before.
    """
    from shoplens.plans.checks import validate
    from shoplens.streaming.arrivals import run_stream_ingest
    from shoplens.streaming.incremental import dates_since, run_incremental_ingest

    if rebuild not in ("touched", "all"):
        raise ValueError(rebuild)
    out_dir = out_dir.rstrip("/")
    checkpoint_root = checkpoint_root or f"{out_dir}/_checkpoints"
    seconds: dict[str, float] = {}
    t0 = time.perf_counter()
    take_in = run_stream_ingest if stream else run_incremental_ingest
    result = take_in(spark, raw_dir, f"{out_dir}/events", checkpoint_root, sample_weeks=sample_weeks,
                     full_refresh=full_refresh, mode=mode, files_per_batch=files_per_batch)
    seconds["ingest"] = time.perf_counter() - t0
    result |= {"tables": {}, "names": [], "seconds": seconds, "checks": {}, "warehouse": None,
               "version": None, "rebuilt": "nothing"}
    if not _has_data(spark, f"{out_dir}/events"):
        return result | {"status": "no_data"}
    layers = ("clean", "fact", *MART_LAYERS)
    newest = versions.current(spark, out_dir)
    built_from = {"generation": result["generation"], "batch_id": result["batch_id"],
                  "sample_days": sample_days, "sample_weeks": sample_weeks, "mode": mode}
    # A version of other samples, or of another generation, says nothing of this one.
    fits = (newest is not None and set(layers) <= set(newest["layers"])
            and all(newest[k] == v for k, v in built_from.items() if k != "batch_id"))
    if fits and sample_days is None and newest["batch_id"] == result["batch_id"] and rebuild == "touched":
        p = CsvPipeline(spark, raw_dir, out_dir, version_dir=newest["path"])
        p.reopen(newest, layers)
        result |= {"version": newest["version"], "rebuilt": "nothing"}
    else:
        result["version"], folder = versions.begin(spark, out_dir)
        p = CsvPipeline(spark, raw_dir, out_dir, sample_days, folder)
        touched = (dates_since(spark, checkpoint_root, newest["generation"], newest["batch_id"])
                   if fits and sample_days is None and rebuild == "touched" else None)
        t0 = time.perf_counter()
        if touched and p.refresh(newest, touched):
            seconds["refresh"] = time.perf_counter() - t0
            result["rebuilt"] = "touched"
            missing = [m for m in MART_LAYERS if m not in refresh.DATED]
        else:
            for layer in ("clean", "fact"):     # staging table, then the shared fact table
                t0 = time.perf_counter()
                p.build(layer)
                seconds[layer] = time.perf_counter() - t0
            result["rebuilt"], missing = "all", MART_LAYERS
        seconds.update(p.build_many(missing, threads))
        versions.publish(spark, out_dir, result["version"], folder, list(layers),
                         refresh.stored_parts(p.parts),
                         {k: getattr(p, k).columns for k in layers}, **built_from)
        versions.expire(spark, out_dir)
    if publish:
        result["names"] = register_tables(p, layers, prefix)
    t0 = time.perf_counter()
    result["checks"] = validate(p, check)
    seconds["checks"] = time.perf_counter() - t0
    return result | {"tables": {k: p.folder_of(k) for k in ("events", *layers)}, "warehouse": p}


# Catalog names of the layers (schema, table), as the models are known.
TABLE_NAMES = {
    # the loaded staging table carries the source name; the staging model
    # (a view in the original) gets its own name when published
    "clean": ("staging", "stg_events"), "stg": ("staging", "stg_events_model"),
    "fact": ("marts", "fact_events"), "sessions": ("marts", "fact_sessions"),
    "funnel": ("marts", "mart_funnel_daily"),
    "retention": ("marts", "mart_retention_cohort_weekly"),
    "growth": ("marts", "mart_category_growth_weekly"), "rfm": ("marts", "mart_rfm"),
    "price_performance": ("marts", "mart_price_performance"),
    "product_matrix": ("marts", "mart_product_matrix"),
}


def publish_tables(wh: Warehouse, layers=("fact", "sessions", *MART_LAYERS[1:]),
                   prefix: str = "") -> list[str]:
    """Register layers as catalog tables (full replace), ``<schema>.<table>``
    with an optional schema prefix.  The staging model is not published by
    default (a view in the original)."""
    names = []
    for layer in layers:
        schema, table = TABLE_NAMES[layer]
        schema = f"{prefix}{schema}"
        wh.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        name = f"{schema}.{table}"
        getattr(wh, layer).write.mode("overwrite").saveAsTable(name)
        names.append(name)
    return names


def register_tables(wh: MaterializedWarehouse, layers, prefix: str = "") -> list[str]:
    """Name the stored layers in the catalog: a lasting view over each folder,
    replaced in one statement, so a name never vanishes and never shows a
    half-written table.  The staging model is such a view over the staging
    table."""
    spark, names = wh.spark, []
    for layer in layers:
        schema, table = TABLE_NAMES[layer]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{schema}")
        name = f"{prefix}{schema}.{table}"
        parts = wh.parts.get(layer) or [refresh.Part(wh._path(layer))]
        _replace_view(spark, name, refresh.select_parts(parts, refresh.DATED.get(layer),
                                                        getattr(wh, layer).columns))
        names.append(name)
    if "clean" in layers:
        (schema, source), (_, model) = TABLE_NAMES["clean"], TABLE_NAMES["stg"]
        _replace_view(spark, f"{prefix}{schema}.{model}",
                      staging.stg_events_sql(f"{prefix}{schema}.{source}"))
    return names


def _replace_view(spark: SparkSession, name: str, query: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")         # a table that publish_tables left
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
