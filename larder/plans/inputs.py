"""The synthetic tables seen as a catalogue: part = product, supplier = store, lineitem = prices.

The mappings are plain SQL expressions over whole tables. Nested records are built within each
row, so no group is collected to make one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import spread

STEP = """case p_type when 'SMALL' then 'Plats' when 'PROMO' then 'Boissons'
    when 'ECONOMY' then 'Entrées' when 'LARGE' then 'Desserts' when 'MEDIUM' then 'Fromages' end"""
ROLE = """case when p_type = 'SMALL' then case when p_brand in
    ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') then 'side' else 'main' end end"""
STATUS = "case when p_brand = 'Brand#25' then 'inactive' else 'active' end"
PERSONS = "case when p_size <= 42 then p_size end"
NAME = """concat(case when p_size < 8 then 'Plateau de ' when p_size < 16 then '12 mini '
    when p_size < 24 then 'Assortiment d''' when p_size < 30 then 'Crêpe '
    when p_size < 36 then 'crèpes ' when p_size < 40 then 'Duo (bio) ' else '' end,
    p_name, ' - ', p_size, ' pièces')"""


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").selectExpr(
        "p_partkey as product_id", "concat('S', p_partkey) as sku", f"{NAME} as name",
        f"{STATUS} as status", f"{STEP} as menu_step", f"{ROLE} as dish_role",
        f"{PERSONS} as persons",
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """One price per product and store; line items of a pair combine before the shuffle."""
    lines = load(spark, folder, "lineitem")
    return lines.groupBy(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id")
    ).agg(F.max("l_extendedprice").alias("price"))


def price_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One export line per line item: both generations of price fields, and entries without."""
    rows = spread(load(spark, folder, "lineitem")).selectExpr(
        """to_json(named_struct('product_id', cast(l_partkey as string), 'stores', array(
            named_struct('store_id', l_suppkey,
                'prices', case when l_discount > 0 then array(
                    named_struct('price', cast(l_extendedprice as string)),
                    named_struct('price', cast(l_quantity as string))) else array() end,
                'price', named_struct('price', cast(null as string))),
            named_struct('store_id', cast(l_linenumber as bigint), 'prices', cast(null as array<struct<price:string>>),
                'price', case when l_tax > 0 then named_struct('price', cast(l_extendedprice as string)) end),
            named_struct('store_id', cast(null as bigint), 'prices', cast(null as array<struct<price:string>>),
                'price', case when l_returnflag = 'A' then named_struct('price', cast(l_quantity as string)) end)
        ))) as value""",
        "named_struct('day', l_shipdate, 'line', l_orderkey, 'part', l_linenumber) as position",
    )
    return rows


def product_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One export line per part, with every field that changes type from row to row."""
    rows = spread(load(spark, folder, "part")).withColumn("name", F.expr(NAME))
    json = """concat('{"product_id":"', p_partkey, '","sku":"S', p_partkey, '","name":"', name,
        '","status":"', case when p_brand = 'Brand#25' then 'Désactivé' else 'Activé' end,
        '","type_id":"', case when p_size < 6 then ' Bundle ' else 'simple' end,
        '","nb_portion":', case when p_size > 42 then 'null' when p_size > 20 then cast(p_size as string)
            else concat('"', p_size, '.0000"') end,
        ',"weight":"', p_size * 10, '.0000"',
        ',"type_envie":', case when p_size < 10 then '"Sans Porc"' when p_size < 25
            then '["froid"," Végétarien ","SANS PORC","sans porc"]' when p_size < 40 then '[]' else 'null' end,
        ',"delai_prepa":', case when p_size < 25 then '"2"' else '3.0' end,
        ',"image":"', case when p_size < 30 then concat('//p/', p_partkey, '.jpg') else '' end, '"',
        ',"suppliers_department":"', p_brand, '"',
        ',"categories":[{"category_id":', p_size, ',"category_name":"', p_type, '"},{"category_id":"x","category_name":"', p_brand, '"}]',
        ',"ingredients":"&lt;b&gt;', p_name, '&lt;/b&gt;&amp;amp; sel"',
        case when p_type = 'LARGE' then concat(',"composition":{"title":"T","pieces":["', p_name,
            '",{"name":"', p_brand, '","qty":"', p_size, '","image":"/i.png"},{"qty":0},7]}') else '' end,
        case when p_type = 'MEDIUM' then concat(',"composition_plateau":{"title":"C","qty":"', p_size,
            '","groups":[{"name":"G","pieces":[{"code":"0-0","name":"', p_name, '","price":"', p_size,
            '.5"},{"code":"0-1","disabled":" ON "},9]},{"name":"E","pieces":[{"code":"1-0","disabled":"on"}]},{"name":"H","pieces":[{"code":"2-0","name":"',
            p_brand, '","price":0,"ingredients":"', case when p_size < 25 then 'lait' else '' end, '"}]},"x"]}') else '' end,
        '}') as value"""
    return rows.selectExpr(json, "p_partkey as position")


def store_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One export line per supplier."""
    json = """concat('{"store_id":', s_suppkey, ',"name":"', s_name, '","city":"N', s_nationkey, '"',
        case when s_acctbal < 2000 then ',"is_active":true' when s_acctbal < 4000 then ',"is_active":null' else '' end,
        ',"drive":', case when s_nationkey < 12 then 'true' else 'false' end,
        ',"longitude":"', s_acctbal / 40, '","latitude":', s_nationkey * 4 - 10,
        case when s_nationkey < 20 then concat(',"lad_postcodes":["', s_nationkey, '","75001"]') else '' end,
        '}') as value"""
    return load(spark, folder, "supplier").selectExpr(json, "s_suppkey as position")
