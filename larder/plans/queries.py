"""The operators as queries over the synthetic tables; ``oracle.py`` has the same in plain SQL."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import numbers as N
from larder.functions import product as P
from larder.functions import text as X
from larder.operators import concepts as C
from larder.operators import families as FA
from larder.operators import labels as L
from larder.operators import median
from larder.operators import merge as M
from larder.operators import prices as R
from larder.operators import reports, vectors
from larder.plans import catalogue, documents, inputs, rules
from larder.plans.inputs import load
from larder.session import shared_folder, spread
from larder.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


IMAGES = "https://img.example/catalog"
PIECES = "https://img.example"

# --- catalogue ------------------------------------------------------------------------


@query
def catalogue_step_cost(spark, sf):
    cells = catalogue.step_cells(inputs.prices(spark, sf), inputs.products(spark, sf))
    return cells.select("store_id", "menu_step", "n", F.round("typical_cost", 8).alias("typical_cost"))


@query
def catalogue_rollup(spark, sf):
    summary = catalogue.build_store_catalogue(inputs.prices(spark, sf), inputs.products(spark, sf))

    def joined(column, show):
        pairs = F.transform(
            F.map_entries(column), lambda e: F.concat(e["key"], F.lit(":"), show(e["value"]))
        )
        return F.array_join(pairs, ",").alias(column)

    return summary.select(
        "store_id",
        joined("step_catalogue", lambda n: n.cast("string")),
        joined("step_families", lambda labels: F.array_join(labels, "|")),
        joined("step_typical_cost", lambda v: F.round(v * 100_000_000).cast("bigint").cast("string")),
    )


def _stores(spark, sf):
    """Suppliers sell; customers, with negative numbers, are stores without prices."""
    selling = load(spark, sf, "supplier").selectExpr("s_suppkey as store_id", "s_acctbal >= 2000 as is_active")
    idle = load(spark, sf, "customer").selectExpr("-c_custkey as store_id", "c_acctbal >= 2000 as is_active")
    return selling.unionByName(idle)


@query
def catalogue_fill_empty(spark, sf):
    """Customers stand in for stores that sell nothing."""
    stores = _stores(spark, sf).withColumn("step_floor", F.lit(1))
    summary = catalogue.build_store_catalogue(inputs.prices(spark, sf), inputs.products(spark, sf))
    filled = catalogue.apply_catalogue(stores, summary)
    return filled.select(
        "store_id",
        "is_active",
        F.size("step_catalogue").cast("bigint").alias("n_steps"),
        F.size("step_families").cast("bigint").alias("n_families"),
    )


@query
def catalogue_counters(spark, sf):
    stores = _stores(spark, sf)
    cells = catalogue.step_cells(inputs.prices(spark, sf), inputs.products(spark, sf))
    return catalogue.catalogue_counts(stores, cells.select("store_id").distinct())


@query
def families_per_step(spark, sf):
    return catalogue.step_families(inputs.prices(spark, sf), inputs.products(spark, sf)).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query
def names_per_step(spark, sf):
    return catalogue.step_names(inputs.prices(spark, sf), inputs.products(spark, sf))


@query
def line_families(spark, sf):
    """Families over every line of every document, per language."""
    docs = spread(load(spark, sf, "documents").select("lang", "text"))
    lines = docs.select("lang", F.explode(F.split("text", "\n")).alias("name"))
    # Equal words combine first; their keys are worked out once per word, not per line.
    words = lines.select("lang", X.family_word(F.col("name")).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("times"))
    keyed = counts.withColumn("key", X.fold_word(F.col("word")))
    ranked = FA.rank_families(keyed, ["lang"], n="times")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


# --- prices ---------------------------------------------------------------------------


@query
def price_ref(spark, sf):
    lines = load(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_extendedprice as price")
    return R.reference_prices(lines)


@query
def price_index(spark, sf):
    lines = inputs.price_lines(spark, sf)
    day = F.unix_seconds(F.col("position.day").cast("timestamp")).cast("decimal(38,0)")
    place = day * F.lit("1" + "0" * 20).cast("decimal(21,0)") + (F.col("position.line") * 10 + F.col("position.part"))
    return R.latest_reference_prices(R.read_price_records(lines.withColumn("position", place.cast("decimal(38,0)"))))


@query
def price_flatten(spark, sf):
    records = R.read_price_records(inputs.price_lines(spark, sf))
    return R.flatten_prices(records).select(
        "product_id", "store_id", "price",
        F.col("position.line").alias("orderkey"), F.col("position.part").alias("linenumber"),
    )


@query
def event_median(spark, sf):
    """Exact median of a few groups that hold all rows between them."""
    events = load(spark, sf, "events")
    found = median.exact_median(events, ["event_type"], "value", "typical")
    return found.withColumn("typical", F.round("typical", 6))


@query
def run_counters(spark, sf):
    """Counters of a price run: lines, entries, rows, and entries that gave none."""
    return R.price_counters(R.read_price_records(inputs.price_lines(spark, sf)))


# --- tables ---------------------------------------------------------------------------


def _early_late(spark, sf):
    lines = load(spark, sf, "lineitem")
    # Lines before and from one day on: keys on either side alone, and on both.
    key = F.col("l_orderkey").alias("product_id")
    early = lines.where("l_shipdate < timestamp_ntz '1998-06-01'").groupBy(key)
    late = lines.where("l_shipdate >= timestamp_ntz '1998-06-01'").groupBy(key)
    old = early.agg(
        F.max("l_extendedprice").alias("price"), F.max("l_quantity").alias("quantity"),
        F.max("l_tax").alias("tax"),
    )
    new = late.agg(
        F.max("l_extendedprice").alias("price"),
        F.nullif(F.max("l_quantity"), F.lit(50.0)).alias("quantity"),
        F.max("l_discount").alias("discount"),
    )
    return old, new


@query
def upsert_merge(spark, sf):
    return M.upsert(*_early_late(spark, sf), ["product_id"])


@query
def upsert_metrics(spark, sf):
    old, new = _early_late(spark, sf)
    new = new.select("product_id", F.lit(50.0).alias("quantity"))
    return M.upsert_counts(old, new, ["product_id"])


@query
def upsert_composite(spark, sf):
    lines = load(spark, sf, "lineitem")
    key = [F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id")]

    def half(condition):
        return lines.where(condition).groupBy(*key).agg(F.max("l_extendedprice").alias("price"))

    old = half("l_shipdate < timestamp_ntz '1998-06-01'")
    new = half("l_shipdate >= timestamp_ntz '1998-06-01'")
    return M.upsert(old, new, ["product_id", "store_id"])


@query
def last_line_wins(spark, sf):
    """Last order line per product and store, by ship date and then order."""
    lines = load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_extendedprice").alias("price"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice").alias("position"),
    )
    return M.last_by_key(lines, ["product_id", "store_id"], "position").drop("position")


@query
def soft_delete(spark, sf):
    """Customers are in the export if they have orders; suppliers, with negative numbers, are not."""
    status = "case when {0} >= 0 then 'active' when {0} < -500 then 'inactive' end as status"
    table = load(spark, sf, "customer").selectExpr("c_custkey", status.format("c_acctbal"))
    table = table.unionByName(load(spark, sf, "supplier").selectExpr("-s_suppkey as c_custkey", status.format("s_acctbal - 4000")))
    seen = load(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    gone = M.soft_delete(table, seen, ["c_custkey"], "status", "inactive", now)
    return gone.select("c_custkey", "status", F.col("removed_at").isNotNull().alias("removed"))


@query
def merge_export(spark, sf):
    """What a stage does to a table: customers and suppliers, and an export of those with orders, and of nations."""
    old = load(spark, sf, "customer").selectExpr("c_custkey as id", "c_acctbal as amount", "'active' as status")
    old = old.unionByName(load(spark, sf, "supplier").selectExpr(
        "-s_suppkey as id", "s_acctbal as amount", "case when s_acctbal < 2000 then 'inactive' else 'active' end as status"
    ))
    spent = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("amount"))
    export = spent.unionByName(load(spark, sf, "nation").selectExpr("-1000000 - n_nationkey as id", "cast(null as double) as amount"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    merged = M.merge_export(old, export.withColumn("status", F.lit("active")), ["id"], now, ("status", "inactive"))
    return merged.select("id", "amount", "status", F.col("removed_at").isNotNull().alias("removed"), "change")


@query
def change_feed(spark, sf):
    """Keys by what a merge of later lines into earlier ones does to them."""
    merged = M.merge_export(*_early_late(spark, sf), ["product_id"], F.current_timestamp())
    return M.change_feed(merged, ["product_id"])


@query
def update_matched(spark, sf):
    """Set a column on customers that have orders; others keep theirs."""
    table = load(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("amount"))
    spent = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("amount")
    )
    return M.update_matched(table, spent, ["c_custkey"])


@query
def drop_fields(spark, sf):
    return M.drop_fields(load(spark, sf, "customer"), ("c_name", "c_mktsegment", "embed_text"))


# --- scalar functions -----------------------------------------------------------------


@query
def safe_int_persons(spark, sf):
    rows = load(spark, sf, "part").selectExpr(
        "p_partkey as product_id",
        """case when p_size < 10 then concat(p_size, '.7500') when p_size < 20 then concat(' ', p_size, ' ')
           when p_size < 24 then 'n/a' when p_size < 30 then concat('-', p_size, '.9')
           when p_size < 34 then concat('1e', p_size - 28) when p_size < 38 then concat(p_size, 'd')
           when p_size < 42 then '0' when p_size < 46 then null else cast(p_size as string) end as t""",
    )
    return rows.select(
        "product_id", N.safe_int(F.col("t")).alias("whole"), N.persons(F.col("t")).alias("persons")
    )


@query
def volume_guard(spark, sf):
    rows = load(spark, sf, "part").selectExpr(
        "p_partkey as product_id", "concat(p_size * 10, '.0000') as weight", f"{inputs.STEP} as step"
    )
    return rows.select("product_id", N.volume_ml(F.col("weight"), F.col("step")).alias("volume_ml"))


@query
def cents(spark, sf):
    """Cent rounding of averages of two prices, where ties are common."""
    lines = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "(l_extendedprice + l_quantity / 200) / 8 as v"
    )
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", N.round_cents(F.col("v")).alias("v"))


@query
def dietary_tags(spark, sf):
    rows = load(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.parse_json(
            F.expr(
                """concat('{"type_envie":', case when p_size < 10 then '"sans VIANDE  "' when p_size < 20 then '["brunch","SANS poisson",12,"  Végétarien","sans poisson "]'
                when p_size < 30 then '["terroir","sans sel"]' when p_size < 40 then '[{"a":1},"sans Porc",null]' else 'null' end, '}')"""
            )
        ).alias("record"),
    )
    return rows.select("product_id", F.array_join(P.dietary_tags(F.col("record")), ",").alias("tags"))


@query
def keyword_recommendable(spark, sf):
    rows = load(spark, sf, "part").selectExpr(
        "p_partkey as product_id",
        """case p_type when 'SMALL' then concat(p_name, ' Au Choix') when 'LARGE' then concat('Composez ', p_name)
           when 'PROMO' then concat(p_name, ' À PRÉCISER') when 'MEDIUM' then null
           else concat(p_name, ' (à garnir)') end as name""",
        "case when p_size < 10 then ' Bundle' when p_size < 40 then 'simple' end as type_id",
        "p_brand = 'Brand#3' as composable",
        "p_size > 4 as pieces",
    )
    return rows.select(
        "product_id",
        P.recommendable(F.col("name"), F.col("type_id"), F.col("composable"), F.col("pieces")).alias(
            "recommendable"
        ),
    )


@query
def override_cascade(spark, sf):
    rows = load(spark, sf, "part").selectExpr(
        "p_partkey as product_id",
        """concat(p_name, ' ', case p_brand when 'Brand#1' then 'Mousseux sans alcool' when 'Brand#2' then 'PUNCH SANS-ALCOOL du bar'
           when 'Brand#3' then 'coffret champomy x 6' when 'Brand#4' then 'EAU plate aromatisée menthe'
           when 'Brand#5' then 'trois eaux légères aromatisées' when 'Brand#6' then 'deux thés, un thé glacé'
           when 'Brand#7' then 'petite boisson au the blanc' when 'Brand#8' then 'ice tea mangue' when 'Brand#9' then 'pack ICE-TEA'
           when 'Brand#10' then 'assortiment de thés noirs' when 'Brand#11' then 'grand café crème' when 'Brand#12' then 'bol de chicorée'
           when 'Brand#13' then 'INFUSION du soir' when 'Brand#14' then 'athénée rosé' when 'Brand#15' then 'plateau aromatisé'
           when 'Brand#16' then 'seau de glaçons' else 'cidre brut' end) as name""",
    )
    return rows.select("product_id", X.drink_role_by_name(F.col("name")).alias("role"))


@query
def html_clean(spark, sf):
    pages = spread(load(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", X.clean_html(F.col("html"), max_chars=None).alias("text"))


@query
def image_url(spark, sf):
    path = F.regexp_extract("url", r"^https?://[^/]+(/.*)$", 1)
    return load(spark, sf, "pages").select("page_id", P.image_url(path, IMAGES).alias("image_url"))


@query
def status_map(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "case o_orderstatus when 'F' then 'Activé' when 'O' then 'activé' end as raw"
    )
    return rows.select("o_orderkey", P.status(F.col("raw")).alias("status"))


@query
def geo_bounds(spark, sf):
    rows = load(spark, sf, "customer").selectExpr(
        "c_custkey",
        "case when c_mktsegment = 'HOUSEHOLD' then 'n/a' else cast(c_acctbal / 40 as string) end as lng",
        "case when c_mktsegment = 'MACHINERY' then null else cast(c_nationkey * 5 - 20 as string) end as lat",
    )
    point = P.geo_point(F.col("lng"), F.col("lat"))
    return rows.select(
        "c_custkey",
        point["coordinates"][0].alias("lng"),
        point["coordinates"][1].alias("lat"),
        P.geo_out_of_bounds(F.col("lng"), F.col("lat")).alias("outside"),
    )


@query
def piece_summary(spark, sf):
    """Lines of a document as the pieces of an assortment."""
    docs = spread(load(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", P.piece_summary(F.split("text", "\n")).alias("summary"))


@query
def prompt_lines(spark, sf):
    rows = load(spark, sf, "part").selectExpr(
        "p_partkey as product_id", "p_name", "p_brand", "p_type",
        "case when p_size < 25 then array(p_type, null, '', p_brand, 'a', 'b', 'c') else array('') end as cats",
        "case when p_size < 40 then split(concat(p_name, ' a b c d  e f g h'), ' ') end as pieces",
    )
    line = P.product_line(F.col("p_name"), F.col("p_brand"), F.col("cats"), P.piece_summary(F.col("pieces")))
    diet = P.diet_line(F.col("p_name"), F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type")))
    return rows.select("product_id", line.alias("line"), diet.alias("diet"))


# --- product and store tables ---------------------------------------------------------


def _records(spark, sf):
    return documents.parsed(documents.keyed_lines(inputs.product_lines(spark, sf), "product_id"))


@query
def json_records(spark, sf):
    """JSON lines between blank ones, parsed back to fields; those of one status repeat a key, whose last value holds."""
    lines = inputs.product_lines(spark, sf)
    again = F.concat(F.lit('{"suppliers_department":"old","extra":{"a":1,"a":2},'), F.expr("substring(value, 2)"))
    lines = lines.withColumn("value", F.when(F.contains("value", F.lit("Désactivé")), again).otherwise(F.col("value")))
    lines = lines.select(F.explode(F.array("value", F.lit(" \t"), F.lit(""))).alias("value"), "position")
    return files.parse_records(lines).select(
        F.variant_get("record", "$.product_id", "bigint").alias("product_id"),
        F.variant_get("record", "$.suppliers_department", "string").alias("department"),
        F.try_variant_get("record", "$.nb_portion", "string").alias("portions"),
    )


@query
def composition_shape(spark, sf):
    shaped = _records(spark, sf).select(
        "product_id", F.col("record"), P.composition(F.col("record"), PIECES).alias("c")
    )
    rows = shaped.select("product_id", F.col("c.title"), F.posexplode("c.pieces").alias("place", "p"))
    return rows.select("product_id", "title", F.col("place").cast("bigint").alias("place"), "p.*")


@query
def plateau_shape(spark, sf):
    shaped = _records(spark, sf).select(
        "product_id",
        P.composable(F.col("record")).alias("composable"),
        P.plateau(F.col("record"), PIECES).alias("c"),
    )
    groups = shaped.select("product_id", "composable", "c.qty", F.explode_outer("c.groups").alias("g"))
    return groups.select(
        "product_id", "composable", "qty",
        F.col("g.name").alias("group"), F.explode_outer("g.pieces").alias("p"),
    ).selectExpr(
        "product_id", "composable", "qty", "`group`", "p.code", "p.name", "p.extra_price", "p.ingredients"
    )


def _labels_of_part(spark, sf):
    part = load(spark, sf, "part")
    pairs = F.array(
        F.struct(F.lit("menu_step").alias("field"), F.expr(inputs.STEP).alias("value")),
        F.struct(F.lit("dish_role").alias("field"), F.expr(inputs.ROLE).alias("value")),
        F.struct(
            F.lit("could_fit_event").alias("field"),
            F.expr("case when p_size < 20 then '[\"Barbecue\",\"Mariage\"]' when p_size < 30 then '[]' end").alias("value"),
        ),
        F.struct(
            F.lit("predicted_diet").alias("field"),
            F.expr("case when p_size < 25 then '{\"profile\":\"vegan\",\"contains\":[\"lait\"]}' end").alias("value"),
        ),
    )
    rows = part.select(F.col("p_partkey").alias("product_id"), F.inline(pairs))
    return rows.where("value is not null").selectExpr("*", "'model' as source", "'m1' as model")


@query
def product_document(spark, sf):
    prices = load(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_extendedprice as price")
    docs = documents.product_documents(
        _records(spark, sf),
        R.reference_prices(prices),
        L.pivot_labels(_labels_of_part(spark, sf), "read"),
        F.current_timestamp(),
        IMAGES,
        PIECES,
    )
    return docs.select(
        "product_id", "sku", "name", "status", "type_id", "menu_step", "dish_role", "drink_role",
        "volume_ml", "is_composable", "recommendable", "persons", "family", "price_ref", "department",
        "delai_prepa", "image_url",
        F.array_join("could_fit_event", ",").alias("could_fit_event"),
        F.array_join("dietary_tags", ",").alias("dietary_tags"),
        F.concat_ws("/", "predicted_diet.profile", F.array_join("predicted_diet.contains", ","),
                    "predicted_diet.source", "predicted_diet.model").alias("diet"),
        F.array_join(F.transform("categories", lambda c: F.concat_ws("=", c["id"], c["name"])), ",").alias("categories"),
        F.size("composition.pieces").cast("bigint").alias("n_pieces"),
        F.size("composition_plateau.groups").cast("bigint").alias("n_groups"),
        "raw",
    )


@query
def stored_products(spark, sf):
    """Products that a run stores: those that can be recommended."""
    docs = documents.product_documents(
        _records(spark, sf), spark.createDataFrame([], "product_id long, price_ref double"),
        L.pivot_labels(_labels_of_part(spark, sf)), F.lit("2024-01-01 00:00:00").cast("timestamp"), IMAGES, PIECES,
    )
    kept = docs.where("recommendable")
    return kept.select("product_id", "status", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


@query
def store_document(spark, sf):
    records = documents.parsed(documents.keyed_lines(inputs.store_lines(spark, sf), "store_id"))
    concepts = load(spark, sf, "supplier").where("s_acctbal > 5000").selectExpr(
        "s_suppkey as store_id", "array('Boucherie', 'Pain') as curated_concepts"
    )
    docs = documents.store_documents(records, concepts, F.current_timestamp())
    return docs.select(
        "store_id", "name", "code", "city", "is_active", "withdrawal_store", "drive",
        F.col("geo.coordinates")[0].alias("lng"), F.col("geo.coordinates")[1].alias("lat"),
        F.array_join("lad_postcodes", ",").alias("lad_postcodes"),
        F.array_join("concepts", ",").alias("concepts"),
        F.array_join("curated_concepts", ",").alias("curated_concepts"),
    )


@query
def concepts_unpivot(spark, sf):
    """Event types as wide flags per user and day; a user's last active day counts."""
    types = ["click", "error", "purchase", "signup", "view"]
    events = load(spark, sf, "events")
    flags = [
        F.max(F.when(F.col("event_type") == t, "1").otherwise("0")).alias(t) for t in types
    ]
    wide = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *flags, F.when(F.max("value") > 20, "Activé").otherwise("Désactivé").alias("status")
    )
    wide = wide.withColumn("store", F.col("user_id").cast("string"))
    carried = C.carried_concepts(wide, "store", "status", types, "day")
    sets = C.concept_sets(carried)
    return sets.select("store_id", F.array_join("curated_concepts", ",").alias("concepts"))


# --- labels ---------------------------------------------------------------------------


def _replies(spark, sf, reply):
    """One batch of three items per part, reply text by type of the part."""
    return load(spark, sf, "part").selectExpr(
        "array(p_partkey * 10 + 1, p_partkey * 10 + 2, p_partkey * 10 + 3) as product_ids",
        f"{reply} as reply",
    )


STEP_REPLY = """case p_type when 'SMALL' then '{"1":"DESSERTS","2":" boissons ","3":"Nope"}'
    when 'PROMO' then '```json\n{"1":"Pains","1":"Petit déj","2":["Plats"],"9":"Pains","Gratin":"Plats"}\n```'
    when 'LARGE' then '```{" 1 ":"table & déco","2":null}``` done' when 'MEDIUM' then 'no json'
    when 'ECONOMY' then '["Plats"]' end"""


@query
def label_reply_parse(spark, sf):
    return L.read_replies(_replies(spark, sf, STEP_REPLY), L.menu_step("")).where("value is not null")


EVENT_REPLY = """case p_type when 'SMALL' then '{"1":["mariage","Barbecue","MARIAGE"],"2":"Mariage","3":[]}'
    when 'PROMO' then '{"1":["Mariage","all"],"2":["?"],"3":["pâques"," noël et nouvel an "]}'
    when 'LARGE' then '{"2":[1,null,"Spécial Enfant"]}' end"""


@query
def event_tags(spark, sf):
    read = L.read_replies(_replies(spark, sf, EVENT_REPLY), L.event_fit(""))
    tags = F.array_join(F.from_json("value", "array<string>"), ",")
    return read.select("product_id", tags.alias("tags"), "source")


DIET_REPLY = """case p_type when 'SMALL' then '{"1":{"profil":"Vegan","contient":["LAIT","lait","?"]},"2":{"profil":"vegetarien","contient":["viande"]},"3":"x"}'
    when 'PROMO' then '{"1":{"profil":"poisson","contient":["viande","poisson"]},"2":{"profil":"poisson","contient":["poisson","alcool"]},"3":{"profil":null,"contient":"lait"}}'
    when 'LARGE' then '{"1":{"profil":"viande","contient":["viande","porc"]},"2":{"contient":["crustaces"]}}' end"""


@query
def diet_parse(spark, sf):
    read = L.read_replies(_replies(spark, sf, DIET_REPLY), L.predicted_diet(""))
    diet = F.from_json("value", L.DIET)
    return read.where("value is not null").select(
        "product_id",
        diet["profile"].alias("profile"),
        F.array_join(diet["contains"], ",").alias("contains"),
        "source",
    )


@query
def diet_stamp(spark, sf):
    wide = L.pivot_labels(_labels_of_part(spark, sf), "read")
    return wide.where("predicted_diet is not null").select(
        "product_id", "predicted_diet.profile", "predicted_diet.source", "predicted_diet.model"
    )


DRINK_REPLY = """case p_type when 'SMALL' then '{"1":"VIN","2":"?"}' when 'PROMO' then '{"3":"chaud","1":"soft"}'
    when 'LARGE' then 'oops' end"""


@query
def reply_fallback(spark, sf):
    """Drinks: the name rule wins, then the reply, then the default."""
    batches = _replies(spark, sf, DRINK_REPLY)
    items = load(spark, sf, "part").selectExpr(
        "explode(array(p_partkey * 10 + 1, p_partkey * 10 + 2, p_partkey * 10 + 3)) as product_id",
        "case when p_size < 10 then 'café' when p_size < 20 then 'ice tea' else p_name end as name",
    )
    label = L.drink_role("")
    return L.settle(items, L.read_replies(batches, label), label)


def _cache(spark, sf):
    return load(spark, sf, "labels").selectExpr(
        "doc_id as product_id", "'menu_step' as field",
        "case quality when 1 then 'Plats' else 'Sauces' end as value",
        "case toxic when 1 then 'fallback' else 'model' end as source", "'m1' as model",
    )


@query
def label_cache_split(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("product_id"), "lang")
    return L.uncached(docs, _cache(spark, sf), "menu_step")


@query
def batch_numbering(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id")
    return L.numbered_batches(docs, "doc_id").select(
        *[F.col(c).cast("bigint").alias(c) for c in ("doc_id", "bucket", "batch", "number")]
    )


@query
def label_distribution(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("product_id"))
    steps = L.pivot_labels(_cache(spark, sf)).select("product_id", "menu_step")
    return reports.label_distribution(docs.join(steps, "product_id", "left"), F.col("menu_step"))


@query
def unclassified_warning(spark, sf):
    return reports.unclassified(label_distribution(spark, sf))


@query
def tag_distribution(spark, sf):
    wide = L.pivot_labels(_labels_of_part(spark, sf))
    return reports.tag_distribution(wide, "could_fit_event")


@query
def label_inject(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("product_id"), "lang")
    joined = docs.join(L.pivot_labels(_cache(spark, sf)), "product_id", "left")
    every = F.array(F.lit(vocab.ALL_EVENTS))
    return joined.select(
        "product_id", "lang", "menu_step", "dish_role",
        F.array_join(F.coalesce("could_fit_event", every), ",").alias("could_fit_event"),
    )


def _items(spark, sf):
    """Every part as an item to label; parts of one brand have a cached label."""
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.expr(inputs.STEP).alias("menu_step"),
        P.product_line(
            F.col("p_name"), F.col("p_brand"), F.array("p_type"), F.lit("")
        ).alias("line"),
    )


def _cached_brand(spark, sf, field, value):
    part = load(spark, sf, "part").where("p_brand in ('Brand#1', 'Brand#2')")
    return part.select(
        F.col("p_partkey").alias("product_id"), F.lit(field).alias("field"),
        F.lit(value).alias("value"),
        F.when(F.col("p_brand") == "Brand#1", "model").otherwise("fallback").alias("source"),
        F.lit("m0").alias("model"),
    )


def _enriched(spark, sf, label, call, cached):
    cache = _cached_brand(spark, sf, label.field, cached)
    return L.enrich(_items(spark, sf), label, call, cache, "rules").select(
        "product_id", "value", "source", "model"
    )


@query
def enrich_steps(spark, sf):
    return _enriched(spark, sf, L.menu_step("Produits :"), rules.steps, "Pains")


@query
def enrich_roles(spark, sf):
    return _enriched(spark, sf, L.dish_role("Plats :"), rules.roles, "side")


@query
def enrich_drinks(spark, sf):
    return _enriched(spark, sf, L.drink_role("Boissons :"), rules.drinks, "cidre")


@query
def enrich_events(spark, sf):
    return _enriched(spark, sf, L.event_fit("Produits :"), rules.events, '["Mariage"]')


@query
def enrich_diets(spark, sf):
    return _enriched(spark, sf, L.predicted_diet("Plats :"), rules.diets, '{"profile":"vegan","contains":[]}')


@query
def enrich_retry(spark, sf):
    """Every batch's first call fails, its second one answers."""
    label = L.menu_step("Produits :")
    batches = L.ask(_items(spark, sf), label.heading, rules.Flaky(rules.steps), attempts=3)
    read = L.read_replies(batches, label).where("value is not null")
    tried = batches.select(F.explode("product_ids").alias("product_id"), F.col("attempts").cast("bigint").alias("attempts"), F.col("error").isNotNull().alias("failed"))
    return read.join(tried, "product_id")


@query
def label_save(spark, sf):
    """Labels saved twice as versions of a table: the later ones of a product win, others stay."""
    table = f"{shared_folder(spark)}/label-save-{uuid.uuid4().hex}"
    files.save_version(_cached_brand(spark, sf, "menu_step", "Pains"), table)
    later = load(spark, sf, "part").where("p_size > 20").selectExpr(
        "p_partkey as product_id", "'menu_step' as field", f"{inputs.STEP} as value", "'model' as source", "'m1' as model"
    )
    files.save_version(M.upsert(files.load_table(spark, table), later, ["product_id", "field"]), table)
    return files.load_table(spark, table)


@query
def label_counts(spark, sf):
    """Per field: labels, fallbacks, and names that overrode the model."""
    labels = _labels_of_part(spark, sf).join(
        load(spark, sf, "part").selectExpr("p_partkey as product_id", "p_size", "p_brand"), "product_id"
    )
    marked = labels.withColumn("source", F.when(F.col("p_size") > 40, "fallback").otherwise("model"))
    return reports.label_counts(marked.withColumn("overridden", F.col("p_brand") == "Brand#7"))


@query
def field_distributions(spark, sf):
    return reports.field_distributions(_labels_of_part(spark, sf))


@query
def repair_stale(spark, sf):
    """Parts under a retired step are labelled again, the others keep their step."""
    step = "case p_type when 'LARGE' then 'Plateaux' when 'SMALL' then 'À côté' else p_type end"
    items = _items(spark, sf).drop("menu_step").join(
        load(spark, sf, "part").selectExpr("p_partkey as product_id", f"{step} as menu_step"), "product_id"
    )
    fresh = L.relabel_stale(
        items, L.menu_step("Produits :"), rules.steps, vocab.STALE_STEPS, "rules", dry_run=False
    )
    table = items.select("product_id", "menu_step")
    return M.update_matched(
        table, fresh.select("product_id", F.col("value").alias("menu_step")), ["product_id"]
    )


# --- reports --------------------------------------------------------------------------


@query
def missing_portions(spark, sf):
    return reports.missing_portions(inputs.products(spark, sf)).drop("menu_step")


@query
def gap_report(spark, sf):
    summary = reports.gap_summary(reports.missing_portions(inputs.products(spark, sf)))
    return summary.withColumn("position", F.col("position").cast("bigint"))


@query
def grouped_report(spark, sf):
    """Products without a portion count, numbered within their step."""
    gaps = reports.missing_portions(inputs.products(spark, sf))
    return reports.grouped_report(gaps.select("step", "product_id", "sku"), "step", "product_id")


@query
def stale_steps(spark, sf):
    counts = reports.stale_steps(load(spark, sf, "part"), ("SMALL", "LARGE", "HUGE"), "p_type")
    return counts


@query
def field_presence(spark, sf):
    part = load(spark, sf, "part").selectExpr(
        "case when p_size < 10 then p_name end as is_food",
        "case when p_type = 'SMALL' then p_brand end as embed_text",
    )
    return reports.field_presence(part, vocab.RETIRED_FIELDS)


@query
def any_field(spark, sf):
    part = load(spark, sf, "part").selectExpr(
        "p_partkey", "case when p_size < 10 then p_name end as is_food",
        "case when p_type = 'SMALL' then p_brand end as embed_text",
    )
    return reports.any_field(part, vocab.RETIRED_FIELDS)


@query
def snapshot_counts(spark, sf):
    """Filtered counts of one pass."""
    return inputs.products(spark, sf).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if((F.col("status") == "active") & F.col("menu_step").isNotNull()).alias("with_step"),
        F.count_if(F.col("persons").isNull()).alias("no_portions"),
    )


@query
def latest_export(spark, sf):
    """Orders filed under export names by month; those of the newest export."""
    orders = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey",
        """case o_orderpriority when '5-LOW' then 'products.jsonl'
           when '2-HIGH' then concat('products_prices_', date_format(o_orderdate, 'yyyy-MM'), '-28.jsonl')
           when '1-URGENT' then concat('catalogue_products_', date_format(o_orderdate, 'yyyy-MM'), '-01.jsonl.gz')
           else concat('catalogue_products_', date_format(o_orderdate, 'yyyy-MM'), '-01.jsonl') end as file""",
    )
    return files.latest_export(orders, F.col("file"), "catalogue_products", "products")


# --- vectors --------------------------------------------------------------------------


@query
def vector_records(spark, sf):
    rows = load(spark, sf, "embeddings").join(
        load(spark, sf, "labels").withColumnRenamed("doc_id", "vec_id"), "vec_id", "left"
    )
    embedded = rows.selectExpr(
        "vec_id as product_id", "case when toxic = 1 then array() else embedding end as values",
        "case when quality = 1 then 'Plats' end as menu_step", "case when label > 3 then 'active' end as status",
    )
    # Whole numbers, so that the sums do not depend on their order.
    whole = F.transform("values", lambda v: F.round(v.cast("double") * 1_000_000).cast("bigint"))
    placed = F.transform(whole, lambda v, i: v * (i + 1))
    add = lambda n, v: n + v
    return vectors.vector_records(embedded).select(
        "id", "metadata.menu_step", "metadata.status",
        F.size("values").cast("bigint").alias("width"),
        F.aggregate(whole, F.lit(0).cast("bigint"), add).alias("total"),
        F.aggregate(placed, F.lit(0).cast("bigint"), add).alias("weighted"),
    )


def _names(spark, sf):
    return inputs.products(spark, sf).selectExpr(
        "*", "menu_step <> 'Fromages' as recommendable"
    ).withColumn("name", F.when(F.col("menu_step") == "Desserts", "  ").otherwise(F.col("name")))


@query
def embed_names(spark, sf):
    records = vectors.vector_records(vectors.embed(_names(spark, sf), rules.embedder))
    return records.select(
        "id", "metadata.menu_step", "metadata.status",
        F.get("values", F.lit(0)).cast("double").alias("chars"),
        F.get("values", F.lit(1)).cast("double").alias("words"),
        F.get("values", F.lit(2)).cast("double").alias("e"),
    )


@query
def embed_counters(spark, sf):
    names = _names(spark, sf)
    return vectors.embed_counts(names, vectors.embed(names, rules.embedder))
