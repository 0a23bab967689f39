"""Star schema: built from extracts, stored as Parquet, read back by the analyses.

A stored warehouse is a folder of versions. A refresh writes a whole new version and then adds
a row to ``versions``, so a refresh that stops half-way changes nothing for readers: they take
the last version named there. Older versions stay until someone removes their folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions import calendar as cal
from martloom.operators import contracts
from martloom.operators import dimensions as dims
from martloom.operators.facts import fact_sales
from martloom.operators.scratch import materialize
from martloom.rules import DEFAULT_RULES, Rules
from martloom.sources import extracts

TABLES = [
    "dim_date", "dim_store", "dim_category", "dim_channel", "dim_customer", "fact_sales", "budget",
]

VERSIONS = (
    "number int, version string, unique_ids boolean, extract_rows bigint,"
    " observed map<string,decimal(38,2)>"
)


@dataclass(frozen=True)
class Warehouse:
    """``unique_ids`` says that the grain check of a stored fact has found an id of its own on every line; ``extract_rows`` the
    number of lines in the extract it was built from, where that is known; ``observed`` what was
    measured while a stored fact was written (see :func:`contracts.line_measures`)."""

    dim_date: DataFrame
    dim_store: DataFrame
    dim_category: DataFrame
    dim_channel: DataFrame
    dim_customer: DataFrame
    fact_sales: DataFrame
    budget: DataFrame
    unique_ids: bool = False
    extract_rows: int | None = None
    observed: Mapping[str, Decimal] | None = None
    number: int | None = None
    version: str | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


def build(
    transactions: DataFrame,
    stores: DataFrame,
    budget: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> Warehouse:
    """Plan all seven tables.

    One pass over the transactions gives a small written profile, from which the calendar
    and the two keyed dimensions follow. The given and keyed dimensions are written too, so
    that the joins with the fact are planned on their true size.
    """
    profile = materialize(dims.profile(transactions), "profile")
    span = profile.agg(F.min("first_day").alias("first"), F.max("last_day").alias("last"))
    prices = profile.where(~F.col("is_channel") & F.col("unit_price").isNotNull())
    categories = dims.category_table(prices, rules)
    channels = dims.dim_channel(profile.where("is_channel"), rules)
    lines = profile.where("is_channel").agg(F.sum("rows")).first()[0]
    return Warehouse(
        dim_date=dims.date_table(span, rules),
        dim_store=materialize(dims.dim_store(stores), "stores"),
        dim_category=categories,
        dim_channel=channels,
        dim_customer=dims.dim_customer(transactions),
        fact_sales=fact_sales(transactions, categories, channels),
        budget=budget.select(*schemas.BUDGET.names),
        extract_rows=lines or 0,
    )


def build_from_csv(spark: SparkSession, data_dir: str, rules: Rules = DEFAULT_RULES) -> Warehouse:
    return build(
        extracts.read_transactions(spark, f"{data_dir}/transactions.csv"),
        extracts.read_stores(spark, f"{data_dir}/stores.csv"),
        extracts.read_budget(spark, f"{data_dir}/budget.csv"),
        rules,
    )


def save(
    warehouse: Warehouse,
    out_dir: str,
    fmt: str = "parquet",
    check_grain: bool = True,
    make_current: bool = True,
) -> Warehouse:
    """Full refresh into a new version; returns the stored warehouse.

    Customers are those of the extracts. ``check_grain`` counts repeated transaction ids once;
    where there are none, and no line is without one, the stored warehouse lets views count rows instead of distinct ids.
    Without ``make_current`` readers keep the version they had until :func:`publish`.
    """
    if fmt not in ("parquet", "delta"):
        raise ValueError(f"unknown table format: {fmt}")
    spark = warehouse.fact_sales.sparkSession
    known = _versions(spark, out_dir)
    number = known.agg(F.max("number")).first()[0] + 1 if known is not None else 1
    version = f"v{number:06d}-{uuid.uuid4().hex}"
    observation = Observation()
    stored = {}
    for name, table in warehouse.tables().items():
        watched = {"observation": observation} if name == "fact_sales" else {}
        stored[name] = _write(table, name, f"{out_dir}/{version}", fmt, **watched)
    observed = {name: Decimal(value or 0) for name, value in observation.get.items()}
    unique = _has_ids(observed) and check_grain
    unique = unique and contracts.grain_check(stored["fact_sales"]).first().violations == 0
    whole = Warehouse(**stored, unique_ids=unique, extract_rows=warehouse.extract_rows,
                      observed=observed or None, number=number, version=version)
    if make_current:
        publish(whole, out_dir)
    return whole


def _has_ids(observed: Mapping[str, Decimal] | None) -> bool:
    """Whether the write of the fact is known to have seen no line without an id."""
    return observed is not None and observed.get(contracts.NO_ID) == 0


def publish(stored: Warehouse, out_dir: str) -> None:
    """Make a saved version the current one."""
    row = [(stored.number, stored.version, stored.unique_ids, stored.extract_rows, stored.observed)]
    named = stored.fact_sales.sparkSession.createDataFrame(row, VERSIONS).coalesce(1)
    named.write.mode("append").parquet(f"{out_dir}/versions")


def _versions(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The versions written whole; None if nothing was ever stored here."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{out_dir}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _write(
    table: DataFrame, name: str, out_dir: str, fmt: str, observation: Observation | None = None
) -> DataFrame:
    """Write one table and scan it; the fact by month, since days would make many tiny files.

    ``rebalance`` puts a month's rows together for large files, and splits a month that is
    far larger than the others over several tasks. ``dim_date`` carries the same
    ``year_month``, so a filter on the calendar prunes the fact's folders at run time. The fact
    is observed after its shuffle, in the tasks that write: a task that is run again for a lost
    executor counts once there, while one before the shuffle could count twice.
    """
    if name in ("fact_sales", "dim_date"):
        table = table.withColumn("year_month", cal.year_month(F.col("date_key")))
    path = f"{out_dir}/{name}"
    if name == "fact_sales":
        monthly = table.hint("rebalance", "year_month")
        if observation is not None:
            monthly = monthly.observe(observation, *contracts.line_measures())
        monthly.write.partitionBy("year_month").mode("overwrite").format(fmt).save(path)
    else:
        table.write.mode("overwrite").format(fmt).save(path)
    reader = table.sparkSession.read.format(fmt)
    if fmt == "parquet":  # the schema is known: no need to read it from a file again
        reader = reader.schema(table.schema)
    return reader.load(path)


def load(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> Warehouse | None:
    """The last whole version, or None if there is none."""
    known = _versions(spark, out_dir)
    last = known.orderBy(F.desc("number"), "version").first() if known is not None else None
    if last is None:
        return None
    reader = spark.read.format(fmt)
    tables = {name: reader.load(f"{out_dir}/{last.version}/{name}") for name in TABLES}
    unique = last.unique_ids and _has_ids(last.observed)
    return Warehouse(**tables, unique_ids=unique, extract_rows=last.extract_rows,
                     observed=last.observed, number=last.number, version=last.version)


def load_totals(fact: DataFrame) -> DataFrame:
    """Row count and revenue of the loaded fact."""
    return fact.agg(F.count("*").alias("fact_rows"), F.sum("net_amount").alias("revenue"))


def stored_totals(stored: Warehouse) -> DataFrame:
    """The same of a stored warehouse, as observed while its fact was written: no scan. A version
    stored without measures is counted."""
    if stored.observed is None:
        return load_totals(stored.fact_sales)
    row = [(int(stored.observed["rows"]), stored.observed["revenue"])]
    schema = "fact_rows bigint, revenue decimal(38,2)"
    return stored.fact_sales.sparkSession.createDataFrame(row, schema)
