"""Product and store tables from parsed export records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import product as P
from larder.functions import variants as V
from larder.functions.numbers import persons, safe_int, volume_ml
from larder.functions.text import clean_html, family, is_blank
from larder.operators.merge import last_by_key


def keyed_lines(lines: DataFrame, key: str) -> DataFrame:
    """(key, raw): export lines by their whole-number key; of a repeated key the last line.

    Only the text is shuffled, once, to its key; it is parsed after that, and later joins on
    the key find it in place. A line without the key ends the job.
    """
    found = F.get_json_object("value", f"$.{key}")
    missing = F.raise_error(F.concat(F.lit(f"no {key} in line: "), F.left("value", F.lit(200))))
    rows = lines.where(~is_blank(F.col("value"))).select(
        F.coalesce(found, missing.cast("string")).cast("bigint").alias(key),
        F.col("value").alias("raw"),
        "position",
    )
    return last_by_key(rows, [key], "position").drop("position")


def parsed(rows: DataFrame) -> DataFrame:
    """Adds the parsed ``record`` of each ``raw`` line; text that is no JSON ends the job."""
    return rows.withColumn("record", V.parse(F.col("raw")))


def product_documents(
    records: DataFrame,
    reference_prices: DataFrame,
    labels: DataFrame,
    now: Column,
    image_base: str,
    piece_image_base: str,
    department_field: str = "suppliers_department",
) -> DataFrame:
    """One row per product: export fields, labels, reference price and what follows from them.

    ``records`` has (product_id, record, raw), ``reference_prices`` (product_id, price_ref) and
    ``labels`` one typed row per product. The whole line stays in ``raw``.
    """
    joined = records.join(reference_prices, "product_id", "left").join(labels, "product_id", "left")
    r = F.col("record")
    joined = joined.withColumn("is_composable", P.composable(r))
    every = F.array(F.lit(vocab.ALL_EVENTS))
    return joined.select(
        "product_id",
        V.text(r, "$.sku").alias("sku"),
        V.text_or(r, "$.name", "").alias("name"),
        P.status(V.text(r, "$.status")).alias("status"),
        V.text(r, "$.type_id").alias("type_id"),
        "menu_step",
        "dish_role",
        "drink_role",
        volume_ml(V.text(r, "$.weight"), F.col("menu_step")).alias("volume_ml"),
        F.when(F.size("could_fit_event") > 0, F.col("could_fit_event"))
        .otherwise(every)
        .alias("could_fit_event"),
        "predicted_diet",
        "is_composable",
        P.recommendable(
            V.text(r, "$.name"), V.text(r, "$.type_id"), F.col("is_composable"), P.has_pieces(r)
        ).alias("recommendable"),
        persons(V.text(r, "$.nb_portion")).alias("persons"),
        P.dietary_tags(r).alias("dietary_tags"),
        family(V.text(r, "$.name")).alias("family"),
        "price_ref",
        V.text(r, f"$.{department_field}").alias("department"),
        V.text(r, "$.bac_type").alias("bac_type"),
        V.text(r, "$.expression_pvc").alias("expression_pvc"),
        safe_int(V.text(r, "$.delai_prepa")).alias("delai_prepa"),
        P.image_url(V.text(r, "$.image"), image_base).alias("image_url"),
        P.categories(r).alias("categories"),
        P.composition(r, piece_image_base).alias("composition"),
        P.plateau(r, piece_image_base).alias("composition_plateau"),
        now.alias("ingested_at"),
        "raw",
    )


def store_documents(records: DataFrame, concepts: DataFrame, now: Column) -> DataFrame:
    """One row per store with its place on the map and its curated concepts."""
    r = F.col("record")
    text = [
        "name", "code", "anabel_code", "type_label", "street_1", "street_2", "street_3",
        "city", "postcode",
    ]

    def flag(name: str) -> Column:
        value = F.coalesce(F.try_variant_get(r, f"$.{name}", "boolean"), F.lit(False))
        return F.when(~V.is_null(r, f"$.{name}"), value).alias(name)

    def texts(name: str) -> Column:
        value = F.transform(V.items(r, f"$.{name}"), lambda x: x.try_cast("string"))
        none = F.array().cast("array<string>")
        return F.when(~V.is_null(r, f"$.{name}"), F.coalesce(value, none)).alias(name)

    none = F.array().cast("array<string>")
    return records.join(concepts, "store_id", "left").select(
        "store_id",
        *[V.text(r, f"$.{c}").alias(c) for c in text],
        flag("is_active"),
        flag("withdrawal_store"),
        flag("drive"),
        P.geo_point(V.text(r, "$.longitude"), V.text(r, "$.latitude")).alias("geo"),
        texts("concepts"),
        F.coalesce("curated_concepts", none).alias("curated_concepts"),
        texts("lad_postcodes"),
        now.alias("ingested_at"),
    )


def label_items(records: DataFrame, department_field: str = "suppliers_department") -> DataFrame:
    """(product_id, name, line) to ask labels for."""
    r = F.col("record")
    cats = F.transform(
        V.items(r, "$.categories"), lambda c: F.coalesce(V.text(c, "$.category_name"), F.lit(""))
    )
    return records.select(
        "product_id",
        V.text(r, "$.name").alias("name"),
        P.product_line(
            V.text(r, "$.name"),
            V.text(r, f"$.{department_field}"),
            cats,
            P.piece_summary(P.piece_names(r)),
        ).alias("line"),
    )


def diet_items(records: DataFrame) -> DataFrame:
    """(product_id, name, line) to ask the diet label for."""
    r = F.col("record")
    return records.select(
        "product_id",
        V.text(r, "$.name").alias("name"),
        P.diet_line(V.text(r, "$.name"), clean_html(V.text(r, "$.ingredients"))).alias("line"),
    )
