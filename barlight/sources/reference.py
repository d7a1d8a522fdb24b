"""Reference datasets: pages of JSON to typed tables with a schema and key each, and one operator to list them.

A record's fields that its dataset doesn't have, or whose values don't fit, are kept as text in the
column `rescued`, so that nothing is lost when the service adds a field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.predicates import all_of, compare_filter

# Fields and keys of the datasets.
DATASETS = {
    "splits": ("ticker, execution_date, id", "id string, execution_date date, split_from double, split_to double, ticker string, adjustment_type string, historical_adjustment_factor double"),
    "dividends": ("ticker, ex_dividend_date, id", "id string, cash_amount double, currency string, declaration_date date, dividend_type string, ex_dividend_date date, frequency int, pay_date date, record_date date, ticker string"),
    "contracts": ("ticker, correction", "additional_underlyings array<struct<amount: double, type: string, underlying: string>>, cfi string, contract_type string, correction string, exercise_style string, expiration_date date, primary_exchange string, shares_per_contract double, strike_price double, ticker string, underlying_ticker string"),
    "conditions": ("asset_class, id", "abbreviation string, asset_class string, data_types array<string>, description string, exchange int, id int, legacy boolean, name string, sip_mapping struct<CTA: string, OPRA: string, UTP: string>, type string, update_rules struct<consolidated: struct<updates_high_low: boolean, updates_open_close: boolean, updates_volume: boolean>, market_center: struct<updates_high_low: boolean, updates_open_close: boolean, updates_volume: boolean>>"),
    "holidays": ("date, exchange", "close timestamp, date date, exchange string, name string, open timestamp, status string"),
    "exchanges": ("id", "acronym string, asset_class string, id int, locale string, mic string, name string, operating_mic string, participant_id string, type string, url string"),
    "tickers": ("ticker, market", "active boolean, base_currency_name string, base_currency_symbol string, cik string, composite_figi string, currency_name string, currency_symbol string, delisted_utc timestamp, last_updated_utc timestamp, locale string, market string, name string, primary_exchange string, share_class_figi string, ticker string, type string"),
    "ticker_types": ("asset_class, locale, code", "asset_class string, code string, description string, locale string"),
}


def schema_of(dataset: str) -> T.StructType:
    return T.StructType.fromDDL(DATASETS[dataset][1])


def key_of(dataset: str) -> list[str]:
    return DATASETS[dataset][0].split(", ")


def _records(column: str):
    """The texts of a page's records: of `results`, or of a page that is an array."""
    inside = F.from_json(column, "struct<results: array<string>>")["results"]
    return F.when(F.col(column).rlike(r"^\s*\["), F.from_json(column, "array<string>")).otherwise(inside)


def ingest(pages: DataFrame, dataset: str, column: str = "value") -> DataFrame:
    """A row a record of pages (JSON with an array `results`, or an array), with the dataset's columns and rescued.

    The pages' other columns stand before them. A missing field is null; rescued holds what was given beyond
    the schema or doesn't fit it, by name, and is null where there is nothing. Pages without records, null or
    broken ones give no row; see broken_pages(). Records that are no objects give a row of nulls.
    """
    fields = schema_of(dataset)
    own = [c for c in pages.columns if c != column]
    rows = pages.select(*own, F.explode(_records(column)).alias("record"))
    raw = F.from_json("record", "map<string, string>")
    rows = rows.select(*own, F.from_json("record", fields).alias("typed"), raw.alias("raw"))
    unfit = F.array_compact(F.array(*(F.when(F.col("typed")[f].isNull() & F.try_element_at("raw", F.lit(f)).isNotNull(), F.lit(f)) for f in fields.names)))
    rows = rows.withColumn("unfit", F.coalesce(unfit, F.array().cast("array<string>")))
    rescued = F.map_filter("raw", lambda k, v: ~k.isin(*fields.names) | F.array_contains("unfit", k))
    return rows.select(*own, "typed.*", F.when(F.size(rescued) > 0, rescued).alias("rescued"))


def broken_pages(pages: DataFrame, column: str = "value") -> DataFrame:
    """Pages that hold no array of records."""
    return pages.where(_records(column).isNull())


def latest_records(rows: DataFrame, dataset: str, order: str) -> DataFrame:
    """The last record of each key by a column, which may be a page's number or time; records without any key go."""
    keys = key_of(dataset)
    others = [c for c in rows.columns if c not in keys]
    # Maps can't be compared, so the order alone decides; of equal ones any is taken.
    kept = rows.where(F.coalesce(*(F.col(k).cast("string") for k in keys)).isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("last"))
    return kept.select(*(F.col(c) if c in keys else F.col(f"last.`{c}`").alias(c) for c in rows.columns))


def write_dataset(rows: DataFrame, path: str, dataset: str) -> None:
    """The table of a dataset, in ranges of its key: so each file's statistics tell which keys it may hold."""
    keys = key_of(dataset)
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{dataset}")


def query(spark: SparkSession, path: str, dataset: str, *, sort: str | None = None, order: str = "asc", limit: int | None = None, search: str | None = None, **tests) -> DataFrame:
    """Records of a written dataset that pass comparison tests (field, field__lt, __lte, __gt, __gte, __any_of), sorted and limited.

    sort: a field, by default the key's first; ties are broken by the key. search: words that ticker, name or
    description hold in any case. Unknown fields raise an error. Tests on single values reach the Parquet scan.
    """
    fields = schema_of(dataset)
    unknown = [n for n in [*(t.partition("__")[0] for t in tests), *([sort] if sort else [])] if n not in fields.names]
    if unknown:
        raise ValueError(f"{dataset} has no {', '.join(unknown)}")
    if order not in ("asc", "desc"):
        raise ValueError(f"order is asc or desc, not {order}")
    schema = T.StructType([*fields.fields, T.StructField("rescued", T.MapType(T.StringType(), T.StringType()))])
    rows = spark.read.schema(schema).parquet(f"{path}/{dataset}").where(compare_filter(**tests))
    if search:
        text = F.lower(F.concat_ws(" ", *(c for c in ("ticker", "name", "description") if c in fields.names)))
        rows = rows.where(all_of([text.contains(w) for w in search.lower().split()]))
    if sort is None and limit is None:
        return rows
    keys = list(dict.fromkeys([sort or key_of(dataset)[0], *key_of(dataset)]))
    ordered = rows.orderBy(F.col(keys[0]).asc() if order == "asc" else F.col(keys[0]).desc(), *keys[1:])
    return ordered if limit is None else ordered.limit(limit)


def write_universe(members: DataFrame, path: str, year: str = "year", name: str = "name") -> None:
    """Lists of tickers (year, name, ticker and measures such as market_cap) as CSV with a header, a folder a year and name, sorted by ticker."""
    members.repartition(year, name).sortWithinPartitions(year, name, "ticker").write.mode("overwrite").partitionBy(year, name).option("header", True).csv(path)


def read_universe(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lists written by write_universe(); filters on year and name read their folders only."""
    return spark.read.schema(schema).option("header", True).csv(path)


def corporate_actions_build(splits: DataFrame, dividends: DataFrame, changes: DataFrame, path: str, order: str = "page") -> None:
    """The three tables of corporate actions from pages of splits and dividends, and from ticker events (ticker, events of date and new ticker).

    splits and dividends: the latest record of each key; ticker_changes: ticker, date, new_ticker, once each.
    """
    for dataset, pages in (("splits", splits), ("dividends", dividends)):
        write_dataset(latest_records(ingest(pages, dataset), dataset, order).drop(order), path, dataset)
    rows = changes.select("ticker", F.explode("events").alias("e")).select("ticker", F.col("e.date").alias("date"), F.col("e.ticker").alias("new_ticker"))
    rows.where("new_ticker is not null").distinct().repartitionByRange("ticker", "date").sortWithinPartitions("ticker", "date").write.mode("overwrite").parquet(f"{path}/ticker_changes")
