"""Per-store summary: how many products per step, which families, what a guest costs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import vocab
from larder.operators.families import rank_families, with_family
from larder.operators.median import exact_median
from larder.operators.merge import update_matched
from larder.session import written

CELL = ["store_id", "menu_step"]


def listed(products: DataFrame, *fields: str) -> DataFrame:
    """Active products with a step, narrowed to what the summary needs."""
    rows = products.where("status = 'active' and menu_step is not null")
    return rows.select("product_id", "menu_step", *fields)


def listed_families(products: DataFrame, *fields: str) -> DataFrame:
    """The family is worked out here, once per product instead of once per price row."""
    return with_family(listed(products, "name", *fields), "name").drop("name")


def price_per_person(price: Column, persons: Column, step: Column, role: Column) -> Column:
    """Price per guest; null when unknown, and for side dishes, which anchor no main step."""
    side = (step == vocab.MAIN_STEP) & role.eqNullSafe(F.lit("side"))
    return F.when((persons > 0) & (price > 0) & ~side, price / persons)


def _per_person() -> Column:
    return price_per_person(F.col("price"), F.col("persons"), F.col("menu_step"), F.col("dish_role")).alias("ppp")


def step_cells(prices: DataFrame, products: DataFrame) -> DataFrame:
    """(store_id, menu_step, n, typical_cost): product count and median price per guest."""
    rows = prices.join(listed(products, "persons", "dish_role"), "product_id").select(*CELL, _per_person())
    return exact_median(rows, CELL, "ppp", "typical_cost", size="n")


def step_families(
    prices: DataFrame, products: DataFrame, limit: int = vocab.MAX_FAMILIES
) -> DataFrame:
    """(store_id, menu_step, rank, label, n): the families each store carries per step."""
    rows = prices.select("store_id", "product_id").join(listed_families(products), "product_id")
    return rank_families(rows, CELL, limit)


def step_names(prices: DataFrame, products: DataFrame) -> DataFrame:
    """(store_id, menu_step, name, n): the distinct names behind the families."""
    names = products.where("status = 'active' and menu_step is not null")
    rows = prices.select("store_id", "product_id").join(
        names.select("product_id", "menu_step", "name"), "product_id"
    )
    return rows.groupBy(*CELL, "name").agg(F.count(F.lit(1)).alias("n"))


def roll_up(cells: DataFrame, families: DataFrame) -> DataFrame:
    """One row per store with three maps keyed by step.

    Lists stay small: at most ``limit`` labels per cell and one cell per step and store.
    """
    ranked = families.groupBy(*CELL).agg(
        F.array_sort(F.collect_list(F.struct("rank", "label"))).alias("ranked")
    )
    labels = ranked.withColumn("labels", F.col("ranked.label")).drop("ranked")
    joined = cells.join(labels, CELL, "left")

    def by_step(column: str) -> Column:
        pairs = F.collect_list(F.when(F.col(column).isNotNull(), F.struct("menu_step", column)))
        return F.map_from_entries(F.array_sort(pairs))

    return joined.groupBy("store_id").agg(
        by_step("n").alias("step_catalogue"),
        by_step("labels").alias("step_families"),
        by_step("typical_cost").alias("step_typical_cost"),
    )


def sold(prices: DataFrame, products: DataFrame) -> DataFrame:
    """(store_id, menu_step, key, word, ppp, times): what medians and families both count.

    Prices meet products once; equal rows combine before the shuffle.
    """
    rows = prices.join(listed_families(products, "persons", "dish_role"), "product_id")
    return rows.select(*CELL, "key", "word", _per_person()).groupBy(*CELL, "key", "word", "ppp").agg(F.count(F.lit(1)).alias("times"))


def build_store_catalogue(prices: DataFrame, products: DataFrame, limit: int = vocab.MAX_FAMILIES) -> DataFrame:
    """Summary of every store that sells at least one active product with a step.

    One pass over the prices; what it leaves is written, and read by both halves.
    """
    rows = written(sold(prices, products), "sold")
    cells = exact_median(rows, CELL, "ppp", "typical_cost", size="n", weight="times")
    return roll_up(cells, rank_families(rows, CELL, limit, n="times"))


def apply_catalogue(stores: DataFrame, summary: DataFrame) -> DataFrame:
    """Stores with their summary of today.

    An active store without one gets empty maps: computed, nothing to sell. Null means never
    computed. Summaries of earlier runs are dropped, so none goes stale.
    """
    fields = ["step_catalogue", "step_families", "step_typical_cost"]
    fresh = stores.drop(*fields, "step_floor")
    updated = update_matched(fresh, summary, ["store_id"])
    kinds = {f.name: f.dataType for f in summary.schema}
    empty = {
        c: F.when(
            F.col(c).isNull() & F.col("is_active"), F.create_map().cast(kinds[c])
        ).otherwise(F.col(c))
        for c in fields
    }
    return updated.withColumns(empty)


def catalogue_counts(stores: DataFrame, summary: DataFrame) -> DataFrame:
    """One row (stores_updated, empty_catalogue)."""
    marked = summary.select("store_id", F.lit(True).alias("_sold"))
    joined = stores.join(marked, "store_id", "full_outer")
    return joined.agg(
        F.count_if("_sold").alias("stores_updated"),
        F.count_if(F.col("_sold").isNull() & F.col("is_active")).alias("empty_catalogue"),
    )
