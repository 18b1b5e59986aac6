"""Price rows and reference prices."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.numbers import round_cents
from larder.functions.text import is_blank
from larder.operators.median import exact_median

STORES = (
    "array<struct<store_id:string,prices:array<struct<price:string>>,price:struct<price:string>>>"
)
PRICE_RECORD = f"struct<product_id:string,stores:{STORES}>"


def read_price_records(lines: DataFrame) -> DataFrame:
    """(product_id, stores, position) of price lines; a malformed line ends the job."""
    record = F.from_json("value", PRICE_RECORD, {"mode": "FAILFAST"})
    # A generator evaluates its input once; two field accesses would parse the line twice.
    parsed = lines.where(~is_blank(F.col("value"))).select(F.inline(F.array(record)), "position")
    return parsed.withColumn("product_id", F.col("product_id").cast("bigint"))


def offers(store: Column) -> Column:
    """Prices of one store entry: a non-empty list wins, else the single price."""
    return F.when(F.size(store["prices"]) > 0, store["prices"]).otherwise(
        F.when(store["price"].isNotNull(), F.array(store["price"]))
    )


def flatten_prices(records: DataFrame, need_store: bool = True) -> DataFrame:
    """One row per store and price that is there; other columns are kept.

    With ``need_store`` off, prices of entries without a store id count as well.
    """
    rest = [c for c in records.columns if c != "stores"]
    entries = records.select(*rest, F.explode("stores").alias("store"))
    rows = entries.select(
        *rest, F.col("store.store_id").alias("store_id"), F.explode(offers(F.col("store"))).alias("p")
    )
    rows = rows.where("p.price is not null")
    if need_store:
        rows = rows.where("store_id is not null")
    return rows.select(
        *rest,
        F.col("store_id").cast("bigint").alias("store_id"),
        F.col("p.price").cast("double").alias("price"),
    )


def price_metrics() -> list[Column]:
    """total, entries and price_rows of parsed lines, counted without flattening."""
    priced = F.transform(
        F.filter("stores", lambda s: s["store_id"].isNotNull()),
        lambda s: F.size(F.filter(offers(s), lambda p: p["price"].isNotNull())),
    )
    rows = F.aggregate(priced, F.lit(0), lambda n, m: n + F.greatest(m, F.lit(0)))
    return [
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.greatest(F.size("stores"), F.lit(0))), F.lit(0)).alias("entries"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("price_rows"),
    ]


def with_skipped(counters: dict) -> dict:
    """An entry with several prices gives several rows, so the number can be negative."""
    return {**counters, "skipped_no_price": counters["entries"] - counters["price_rows"]}


def price_counters(records: DataFrame) -> DataFrame:
    """One row (total, entries, price_rows, skipped_no_price)."""
    return records.agg(*price_metrics()).withColumn("skipped_no_price", F.col("entries") - F.col("price_rows"))


def line_prices(stores: Column) -> Column:
    """All prices of a line in order, those of entries without a store id too."""
    found = F.flatten(F.filter(F.transform(stores, offers), lambda p: p.isNotNull()))
    return F.array_sort(F.transform(F.filter(found, lambda p: p["price"].isNotNull()), lambda p: p["price"].cast("double")))


def middle(values: Column) -> Column:
    """Median of a sorted list, null if it is empty."""
    n = F.size(values)
    low, high = F.call_function("div", n - 1, F.lit(2)).cast("int"), F.call_function("div", n, F.lit(2)).cast("int")
    return F.when(n > 0, (F.get(values, low) + F.get(values, high)) / 2)


def latest_reference_prices(records: DataFrame) -> DataFrame:
    """(product_id, price_ref): median price, to the cent, of each product's last line that has any.

    A line's median needs the line alone, so one number per line is left, and one shuffle finds
    the last one. ``position`` should be a number: then the aggregate's buffer is of fixed width,
    and lines of a hot product combine in a hash table before the shuffle.
    """
    lines = records.select("product_id", "position", line_prices(F.col("stores")).alias("values"))
    # A generator evaluates its input once; two uses of the list would sort it twice.
    lines = lines.select("product_id", "position", F.explode(F.array(middle(F.col("values")))).alias("middle"))
    last = lines.where("middle is not null").groupBy("product_id").agg(F.max_by("middle", "position").alias("price_ref"))
    return last.withColumn("price_ref", round_cents(F.col("price_ref")))


def reference_prices(prices: DataFrame, key: str = "product_id", price: str = "price") -> DataFrame:
    """(key, price_ref): median over all stores, to the cent."""
    found = exact_median(prices, [key], price, "price_ref")
    return found.withColumn("price_ref", round_cents(F.col("price_ref")))
