"""Domain refresh: raw tables -> staging views -> mart tables -> quality checks -> cost alert."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly, marts, partials, quality, staging
from ..session import side_by_side
from ..sources.tables import Warehouse
from . import views

# relation -> (function, the relations it reads)
Model = tuple[Callable[..., DataFrame], list[str]]

STAGING: dict[str, dict[str, Model]] = {
    "energy": {"stg_meter_readings": (staging.stg_meter_readings, ["meter_readings"])},
    "ecommerce": {
        "stg_orders": (staging.stg_orders, ["orders"]),
        "stg_customers": (staging.stg_customers, ["customers"]),
        "stg_products": (staging.stg_products, ["products"]),
    },
    "weather": {"stg_weather": (staging.stg_weather, ["hourly_weather"])},
    "requests": {"stg_llm_logs": (staging.stg_llm_logs, ["llm_logs_kafka"])},
}

MARTS: dict[str, dict[str, Model]] = {
    "energy": {"mart_energy_daily": (marts.mart_energy_daily, ["stg_meter_readings"])},
    "ecommerce": {
        "mart_revenue_daily": (marts.mart_revenue_daily, ["stg_orders"]),
        "mart_customer_segments": (marts.mart_customer_segments, ["stg_customers", "stg_orders"]),
    },
    "weather": {"mart_weather_daily": (marts.mart_weather_daily, ["stg_weather"])},
    "requests": {
        "mart_cost_per_user": (marts.mart_cost_per_user, ["stg_llm_logs"]),
        "mart_hourly_activity": (marts.mart_hourly_activity, ["stg_llm_logs"]),
        "mart_latency_analysis": (marts.mart_latency_analysis, ["stg_llm_logs"]),
        "mart_model_comparison": (marts.mart_model_comparison, ["stg_llm_logs"]),
    },
}

MODELS: dict[str, Model] = {
    name: model for layer in (STAGING, MARTS) for models in layer.values() for name, model in models.items()
}

# marts stored in one folder per date, and the raw column that date comes from; the other marts are
# clustered by their presentation order
PARTITIONED_BY = {
    "mart_energy_daily": ("reading_date", "timestamp"),
    "mart_weather_daily": ("reading_date", "date"),
    "mart_hourly_activity": ("request_date", "timestamp"),
}


class QualityError(Exception):
    """A declared check found failing rows."""


def relation(name: str, raw: Callable[[str], DataFrame], built: dict[str, DataFrame]) -> DataFrame:
    """A raw table, staging relation or mart by name, lazily composed from what it reads."""
    if name not in built:
        build, inputs = MODELS.get(name, (None, []))
        built[name] = build(*[relation(i, raw, built) for i in inputs]) if build else raw(name)
    return built[name]


def write_mart(warehouse: Warehouse, name: str, mart: DataFrame) -> DataFrame:
    """Replace a mart table and return it as stored.

    Date folders are filled through a rebalance, which AQE splits where one date is large and
    merges where dates are small. The other marts are range-clustered by their presentation order,
    ties broken by the remaining columns, so that an equal sort key does not pile up in one task
    and file statistics prune scans on the leading key.
    """
    if name in PARTITIONED_BY:
        folder, _ = PARTITIONED_BY[name]
        rows, layout = mart.hint("rebalance", folder), [folder]
    else:
        order = marts.sort_columns(name)
        named = {key.lstrip("-") for key in marts.PRESENTATION_ORDER[name]}
        spread = order + [F.col(c) for c in mart.columns if c not in named]
        rows, layout = mart.repartitionByRange(*spread).sortWithinPartitions(*order), None
    warehouse.replace("marts", name, rows, layout)
    return warehouse.read("marts", name).select(*mart.columns)


def _recent(raw: dict[str, DataFrame], moment: str, since: date) -> dict[str, DataFrame]:
    """Raw rows from ``since`` on and those without a time, cut by a column that file and row-group statistics prune on."""
    time = F.col(moment)
    return {table: rows.filter((time >= F.lit(since)) | time.isNull()) for table, rows in raw.items()}


def _rebuilt(since: date) -> Callable[[str | None], bool]:
    """Whether a date folder is rebuilt: dates from ``since`` on, and rows without a date."""
    return lambda value: value is None or value >= since.isoformat()


def update_mart(warehouse: Warehouse, name: str, raw: dict[str, DataFrame], since: date) -> DataFrame:
    """Rebuild the dates from ``since`` on, and rows without a date, of a mart with date folders; earlier folders stay.

    A date that has lost all its rows loses its folder.
    """
    folder, moment = PARTITIONED_BY[name]
    mart = relation(name, _recent(raw, moment, since).__getitem__, {})
    warehouse.replace_folders("marts", name, mart.hint("rebalance", folder), folder, _rebuilt(since))
    return warehouse.read("marts", name).select(*mart.columns)


def update_partials(warehouse: Warehouse, name: str, raw: dict[str, DataFrame], since: date | None) -> DataFrame:
    """The stored per-date partials of a mart, brought up to date from the raw rows of the dates from ``since`` on.

    Without ``since``, or without stored partials, all dates are built.
    """
    folder = "request_date"
    stored = warehouse.exists("partials", name)
    rows = _recent(raw, "timestamp", since) if since and stored else raw
    (staged,) = MODELS[name][1]
    built = partials.daily(relation(staged, rows.__getitem__, {}), name).hint("rebalance", folder)
    if since and stored:
        warehouse.replace_folders("partials", name, built, folder, _rebuilt(since))
    else:
        warehouse.replace("partials", name, built, [folder])
    return warehouse.read("partials", name)


def alert_rows(alert: DataFrame, top: DataFrame) -> DataFrame:
    """The cost alert as rows of the report: amounts in ten-thousandths of a dollar, the ratio in tenths, the flag as 0 or 1."""

    def units(column: str, factor: int):
        return F.rint(F.col(column) * factor).cast("bigint")

    measures = F.array(*[
        F.struct(F.lit(name).alias("measure"), value.alias("value"))
        for name, value in (
            ("avg_cost_e4", units("avg_cost_usd", 10_000)), ("max_cost_last_hour_e4", units("max_cost_usd", 10_000)),
            ("cost_ratio_e1", units("cost_ratio", 10)), ("is_anomaly", F.col("is_anomaly").cast("bigint")),
        )
    ])
    row = [F.lit("stg_llm_logs").alias("relation"), F.lit("cost_usd").alias("column_name")]
    spender = top.select(
        F.lit("mart_cost_per_user").alias("relation"), F.col("user_id").alias("column_name"), F.lit("top_cost_e4").alias("measure"),
        units("total_cost_usd", 10_000).alias("value"),
    )
    return alert.select(*row, F.inline(measures)).unionByName(spender)


def refresh(
    warehouse: Warehouse,
    domain: str,
    raw: dict[str, DataFrame],
    load: bool = True,
    strict: bool = False,
    since: date | None = None,
    incremental: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Rebuild a domain and report it: (domain, relation, column_name, measure, value).

    ``load=False`` takes ``raw`` as it stands, for a log that a stream keeps appending to. With
    ``since``, the first date whose rows changed, marts with date folders are rebuilt from that date
    on only; the others summarise all dates and are rebuilt in full, or, if ``incremental``, from stored per-date
    partials, of which the same dates are rebuilt, so that no mart reads older raw rows.
    ``strict`` raises :class:`QualityError` when a check fails, after the marts are written. ``as_of`` adds the cost alert of the
    hour before it to the report of the request domain, as its last step.

    Loaded domains get their staging relations as views of the ``staging`` database as well. What the refresh before this one
    superseded is deleted at the start, so readers of a table have until the next refresh to finish. Marts are written side by side.
    """
    for name in MARTS[domain]:
        for layer in ("marts", "partials"):
            if warehouse.exists(layer, name):
                warehouse.drop_superseded(layer, name)
    if load:
        for name in raw:
            if warehouse.exists(f"raw_{domain}", name):
                warehouse.drop_superseded(f"raw_{domain}", name)
        warehouse.load(domain, raw)
        raw = {name: warehouse.read(f"raw_{domain}", name) for name in raw}
        views.create_staging(warehouse, domain)
    relations = dict(raw)
    for name in STAGING[domain]:
        relation(name, raw.__getitem__, relations).createOrReplaceTempView(name)

    def rebuild(name: str) -> DataFrame:
        if incremental and name in partials.KEYS:
            days = update_partials(warehouse, name, raw, since)
            return write_mart(warehouse, name, partials.merged(days, name))
        if since and name in PARTITIONED_BY and warehouse.exists("marts", name):
            return update_mart(warehouse, name, raw, since)
        return write_mart(warehouse, name, relation(name, raw.__getitem__, dict(relations)))

    relations.update(zip(MARTS[domain], side_by_side([partial(rebuild, name) for name in MARTS[domain]])))

    row = ["relation", "column_name", "measure", "value"]
    no_column = F.lit(None).cast("string")
    counts = [
        relations[name].agg(
            F.lit(name).alias("relation"), no_column.alias("column_name"),
            F.lit("rows").alias("measure"), F.count("*").alias("value"),
        )
        for name in [*raw, *MARTS[domain]]
    ]
    if as_of is not None and domain == "requests":
        moment = F.lit(as_of)
        if incremental:
            days = warehouse.read("partials", "mart_model_comparison")
            recent = _recent(raw, "timestamp", (as_of - timedelta(hours=1)).date())
            alert = anomaly.alert_from_partials(days, relation("stg_llm_logs", recent.__getitem__, {}), moment)
        else:
            alert = anomaly.cost_anomaly(relations["stg_llm_logs"], moment)
        counts.append(alert_rows(alert, anomaly.dearest_user(relations["mart_cost_per_user"])))
    checks = quality.report(relations.__getitem__, [domain]).toDF(*row)
    if strict:
        results = checks.collect()  # one row per declared check, so that the checks run once
        checks = warehouse.spark.createDataFrame(results, checks.schema)
        failed = [r for r in results if r.value > 0]
        if failed:
            raise QualityError(", ".join(f"{r.relation}.{r.column_name} {r.measure}: {r.value}" for r in failed))
    return reduce(DataFrame.unionByName, [*counts, checks]).select(F.lit(domain).alias("domain"), *row)
