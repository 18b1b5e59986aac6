"""The same results in plain SQL over the same tables, written without the library."""

_STEP = """case p_type when 'SMALL' then 'Plats' when 'PROMO' then 'Boissons'
    when 'ECONOMY' then 'Entrées' when 'LARGE' then 'Desserts' when 'MEDIUM' then 'Fromages' end"""
_NAME = """concat(case when p_size < 8 then 'Plateau de ' when p_size < 16 then '12 mini '
    when p_size < 24 then 'Assortiment d''' when p_size < 30 then 'Crêpe '
    when p_size < 36 then 'crèpes ' when p_size < 40 then 'Duo (bio) ' else '' end,
    p_name, ' - ', p_size, ' pièces')"""
_ROLE = """case when p_type = 'SMALL' then case when p_brand in
    ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') then 'side' else 'main' end end"""
_PRODUCTS = f"""products as (select p_partkey as product_id, concat('S', p_partkey) as sku, {_NAME} as name,
    case when p_brand = 'Brand#25' then 'inactive' else 'active' end as status, {_STEP} as menu_step,
    {_ROLE} as dish_role, case when p_size <= 42 then p_size end as persons from part)"""
_PRICES = """prices as (select l_partkey as product_id, l_suppkey as store_id, max(l_extendedprice) as price
    from lineitem group by all)"""
_LISTED = """listed as (select * from prices join products using (product_id)
    where status = 'active' and menu_step is not null)"""
_PPP = """case when persons > 0 and price > 0 and not (menu_step = 'Plats' and dish_role is not distinct from 'side')
    then price / persons end"""

_STOP = """('de','du','des','la','le','les','un','une','et','au','aux','à','a','en','pour','avec','sans','sur',
    'dans','d','l','the','mini','minis','maxi','maxis','demi','demie','petit','petite','petits','petites','grand',
    'grande','grands','grandes','gros','grosse','assortiment','assortiments','coffret','lot','pack','sachet',
    'boite','boîte','barquette','plaque','seau','menu','menus','formule','formules','familial','familiale','duo',
    'duos','trio','trios','quatuor','douzaine','douzaines')"""


def _norm(name: str) -> str:
    """SQL text of a name without packaging noise."""
    return f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({name}, '\\([^)]*\\)', ' ', 'g'),
        '[-–].*$', ' '),
        '(^|[^\\p{{L}}\\p{{N}}_])\\p{{Nd}}+([.,]\\p{{Nd}}+)?\\s*(?:g|kg|ml|cl|l|cm|mm|pièces?|pieces?|parts?|personnes?|pers|toasts?|x)([^\\p{{L}}\\p{{N}}_]|$)', '\\1 \\3', 'gi'),
        '["''’,.:;!?/&]', ' ', 'g')"""


def _word(name: str, more: str = "") -> str:
    """SQL text of the family word of a name."""
    return f"""coalesce(list_filter(regexp_split_to_array(lower({_norm(name)}), '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}]+'),
        lambda w: length(w) >= 3 and not regexp_full_match(w, '\\p{{Nd}}+') and w not in {_STOP} {more})[1], '')"""


def _fold(word: str) -> str:
    """SQL text of the grouping key of a word."""
    plain = f"strip_accents(replace(lower({word}), 'œ', 'oe'))"
    return f"regexp_replace({plain}, '^(.{{4,}})[sx]$', '\\1')"


def _cents(v: str) -> str:
    """SQL text of the cent nearest to a positive double's binary value, ties to even."""
    h = f"cast(floor({v}) as bigint)"
    f = f"(cast(({v} - floor({v})) * 4503599627370496 as hugeint) * 100)"
    q, r = f"({f} // 4503599627370496)", f"({f} % 4503599627370496)"
    up = f"""(case when {r} > 2251799813685248 or ({r} = 2251799813685248 and ({h} * 100 + {q}) % 2 = 1)
        then 1 else 0 end)"""
    return f"(cast({h} * 100 + {q} + {up} as double) / 100.0)"


_FAMILIES = f"""named as (select product_id, {_word('name')} as word from products),
    keyed as (select product_id, word, {_fold('word')} as key from named),
    spellings as (select store_id, menu_step, key, word, count(*) as n from listed join keyed using (product_id)
        where word <> '' group by all),
    labelled as (select *, row_number() over (partition by store_id, menu_step, key order by n desc, word) as r,
        sum(n) over (partition by store_id, menu_step, key) as total from spellings),
    ranked as (select store_id, menu_step, word as label, cast(total as bigint) as n,
        row_number() over (partition by store_id, menu_step order by total desc, key) as rank
        from labelled where r = 1),
    families as (select store_id, menu_step, rank, label, n from ranked where rank <= 80)"""

_LINES = """lines as (select l_partkey as product_id, l_suppkey, l_linenumber, l_orderkey, l_shipdate,
        l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag from lineitem),
    entries as (
        select product_id, l_suppkey as store_id, l_extendedprice as price, l_shipdate, l_orderkey, l_linenumber from lines where l_discount > 0
        union all select product_id, l_suppkey, l_quantity, l_shipdate, l_orderkey, l_linenumber from lines where l_discount > 0
        union all select product_id, l_linenumber, l_extendedprice, l_shipdate, l_orderkey, l_linenumber from lines where l_tax > 0
        union all select product_id, null, l_quantity, l_shipdate, l_orderkey, l_linenumber from lines where l_returnflag = 'A')"""

_EARLY_LATE = """early as (select l_orderkey as product_id, max(l_extendedprice) as price, max(l_quantity) as quantity,
        max(l_tax) as tax from lineitem where l_shipdate < timestamp '1998-06-01' group by all),
    late as (select l_orderkey as product_id, max(l_extendedprice) as price, nullif(max(l_quantity), 50) as quantity,
        max(l_discount) as discount from lineitem where l_shipdate >= timestamp '1998-06-01' group by all)"""

_DEAR = f"""{_PRODUCTS}, {_PRICES}, cells as (select store_id, menu_step, count(*) as n,
        count(distinct nullif({_word('name')}, '')) as words
        from prices join products using (product_id)
        where status = 'active' and menu_step is not null group by all),
    sold as (select store_id, count(*) as steps, count(*) filter (words > 0) as named from cells group by all),
    shops as (select s_suppkey, s_acctbal from supplier union all select -c_custkey, c_acctbal from customer)"""

_LABELS = f"""every as (select p_size, p_brand, 'menu_step' as field, {_STEP} as value from part
        union all select p_size, p_brand, 'dish_role', {_ROLE} from part
        union all select p_size, p_brand, 'could_fit_event', case when p_size < 20 then 'b' when p_size < 30 then '' end from part
        union all select p_size, p_brand, 'predicted_diet', case when p_size < 25 then 'v' end from part),
    labels_of as (select * from every where value is not null)"""

_BATCH = """batches as (select *, unnest([1, 2, 3]) as place from part)"""
_FLAGGED = """labels_of as (select doc_id, case quality when 1 then 'Plats' else 'Sauces' end as step, toxic from labels)"""


def _squeeze(t: str) -> str:
    return f"trim(regexp_replace({t}, '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}]+', ' ', 'g'))"


def _unescape(t: str) -> str:
    for entity, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        t = f"regexp_replace({t}, '&{entity};?', '{char}', 'g')"
    return t


_ITEMS = f"""items as (select p_partkey as product_id, p_name as name, p_brand, {_STEP} as menu_step from part)"""


def _enriched(value: str, cached: str, where: str = "true", missing: str | None = None, by_name: str = "null") -> str:
    answered = f"coalesce({value}, {missing})" if missing else value
    return f"""with {_ITEMS}, asked as (
        select product_id, case when p_brand = 'Brand#1' then '{cached}' else {answered} end as value,
            'model' as source, case when p_brand = 'Brand#1' then 'm0' else 'rules' end as model
        from items where {where})
        select * from asked where value is not null"""


ORACLE: dict[str, str] = {
    "catalogue_step_cost": f"""with {_PRODUCTS}, {_PRICES}, {_LISTED}
        select store_id, menu_step, count(*) as n, round(median({_PPP}), 8) as typical_cost from listed group by all""",
    "catalogue_rollup": f"""with {_PRODUCTS}, {_PRICES}, {_LISTED}, {_FAMILIES},
        cells as (select store_id, menu_step, count(*) as n, median({_PPP}) as cost from listed group by all),
        labels_per as (select store_id, menu_step, string_agg(label, '|' order by rank) as labels from families group by all)
        select store_id, string_agg(menu_step || ':' || n, ',' order by menu_step) as step_catalogue,
            coalesce(string_agg(menu_step || ':' || labels, ',' order by menu_step), '') as step_families,
            coalesce(string_agg(menu_step || ':' || cast(round(cost * 100000000) as bigint), ',' order by menu_step), '') as step_typical_cost
        from cells left join labels_per using (store_id, menu_step) group by all""",
    "catalogue_fill_empty": f"""with {_DEAR}
        select s_suppkey as store_id, s_acctbal >= 2000 as is_active,
            coalesce(steps, case when s_acctbal >= 2000 then 0 end) as n_steps,
            coalesce(named, case when s_acctbal >= 2000 then 0 end) as n_families
        from shops left join sold on s_suppkey = store_id""",
    "catalogue_counters": f"""with {_DEAR}
        select count(*) filter (steps is not null) as stores_updated,
            count(*) filter (steps is null and s_acctbal >= 2000) as empty_catalogue
        from shops left join sold on s_suppkey = store_id""",
    "families_per_step": f"""with {_PRODUCTS}, {_PRICES}, {_LISTED}, {_FAMILIES}
        select store_id, menu_step, rank, label, n from families""",
    "names_per_step": f"""with {_PRODUCTS}, {_PRICES}, {_LISTED}
        select store_id, menu_step, name, count(*) as n from listed group by all""",
    "line_families": f"""with lines as (select lang, unnest(string_split(text, chr(10))) as name from documents),
        named as (select lang, {_word('name')} as word from lines),
        spellings as (select lang, {_fold('word')} as key, word, count(*) as n from named where word <> '' group by all),
        labelled as (select *, row_number() over (partition by lang, key order by n desc, word) as r,
            sum(n) over (partition by lang, key) as total from spellings),
        ranked as (select lang, word as label, cast(total as bigint) as n,
            row_number() over (partition by lang order by total desc, key) as rank from labelled where r = 1)
        select lang, rank, label, n from ranked where rank <= 80""",
    "price_ref": f"""with m as (select l_partkey as product_id, median(l_extendedprice) as v from lineitem group by all)
        select product_id, {_cents('v')} as price_ref from m""",
    "price_index": f"""with {_LINES},
        last as (select product_id, max(struct_pack(d := l_shipdate, o := l_orderkey, l := l_linenumber)) as p from entries group by all),
        kept as (select e.product_id, e.price from entries e join last using (product_id)
            where e.l_shipdate = p.d and e.l_orderkey = p.o and e.l_linenumber = p.l),
        m as (select product_id, median(price) as v from kept group by all)
        select product_id, {_cents('v')} as price_ref from m""",
    "price_flatten": f"""with {_LINES}
        select product_id, cast(store_id as bigint) as store_id, price, l_orderkey as orderkey, l_linenumber as linenumber
        from entries where store_id is not null""",
    "event_median": "select event_type, round(median(value), 6) as typical from events group by all",
    "run_counters": f"""with {_LINES}
        select (select count(*) from lines) as total, (select 3 * count(*) from lines) as entries,
            (select count(*) from entries where store_id is not null) as price_rows,
            (select 3 * count(*) from lines) - (select count(*) from entries where store_id is not null) as skipped_no_price""",
    "upsert_merge": f"""with {_EARLY_LATE}
        select coalesce(late.product_id, early.product_id) as product_id,
            case when late.product_id is null then early.price else late.price end as price,
            case when late.product_id is null then early.quantity else late.quantity end as quantity,
            early.tax, late.discount
        from early full join late on early.product_id = late.product_id""",
    "upsert_metrics": f"""with {_EARLY_LATE}
        select count(*) filter (early.product_id is null) as upserted,
            count(*) filter (early.product_id is not null and early.quantity is distinct from 50) as modified
        from late left join early on early.product_id = late.product_id""",
    "upsert_composite": """with old as (select l_partkey as product_id, l_suppkey as store_id, max(l_extendedprice) as price
            from lineitem where l_shipdate < timestamp '1998-06-01' group by all),
        new as (select l_partkey as product_id, l_suppkey as store_id, max(l_extendedprice) as price
            from lineitem where l_shipdate >= timestamp '1998-06-01' group by all)
        select coalesce(new.product_id, old.product_id) as product_id, coalesce(new.store_id, old.store_id) as store_id,
            coalesce(new.price, old.price) as price
        from old full join new on old.product_id = new.product_id and old.store_id = new.store_id""",
    "last_line_wins": """with r as (select l_partkey as product_id, l_suppkey as store_id, l_extendedprice as price,
            row_number() over (partition by l_partkey, l_suppkey
                order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_extendedprice desc) as r from lineitem)
        select product_id, store_id, price from r where r = 1""",
    "soft_delete": """with rows as (select c_custkey, c_acctbal as amount from customer union all select -s_suppkey, s_acctbal - 4000 from supplier),
        t as (select c_custkey, case when amount >= 0 then 'active' when amount < -500 then 'inactive' end as status,
            exists (select 1 from orders where o_custkey = c_custkey) as seen from rows)
        select c_custkey, case when seen then status else 'inactive' end as status,
            not seen and status is distinct from 'inactive' as removed from t""",
    "merge_export": """with old as (select c_custkey as id, c_acctbal as amount, 'active' as status from customer
            union all select -s_suppkey, s_acctbal, case when s_acctbal < 2000 then 'inactive' else 'active' end from supplier),
        new as (select o_custkey as id, max(o_totalprice) as amount from orders group by all
            union all select -1000000 - n_nationkey, null from nation)
        select coalesce(old.id, new.id) as id, case when new.id is null then old.amount else new.amount end as amount,
            case when new.id is null then 'inactive' else 'active' end as status,
            new.id is null and old.status = 'active' as removed,
            case when old.id is null then 'upserted' when new.id is null then case when old.status = 'active' then 'removed' end
                when old.amount is distinct from new.amount or old.status <> 'active' then 'modified' end as change
        from old full join new on old.id = new.id""",
    "change_feed": f"""with {_EARLY_LATE}
        select late.product_id, case when early.product_id is null then 'upserted' else 'modified' end as change
        from late left join early on early.product_id = late.product_id
        where early.product_id is null or early.price is distinct from late.price or early.quantity is distinct from late.quantity
            or late.discount is not null""",
    "update_matched": """select c_custkey, coalesce(spent, c_acctbal) as amount from customer
        left join (select o_custkey, max(o_totalprice) as spent from orders group by all) on o_custkey = c_custkey""",
    "drop_fields": "select c_custkey, c_nationkey, c_acctbal from customer",
    "safe_int_persons": """with t as (select p_partkey as product_id, p_size,
            case when p_size < 20 then p_size when p_size < 24 then null when p_size < 30 then -p_size
                when p_size < 34 then cast(pow(10, p_size - 28) as bigint) when p_size < 38 then null
                when p_size < 42 then 0 when p_size < 46 then null else p_size end as whole from part)
        select product_id, cast(whole as bigint) as whole, cast(case when whole > 0 then whole end as bigint) as persons from t""",
    "volume_guard": """select p_partkey as product_id,
        cast(case when p_type = 'PROMO' and p_size * 10 >= 200 then p_size * 10 end as bigint) as volume_ml from part""",
    "cents": f"""with t as (select l_orderkey, l_linenumber, l_partkey, (l_extendedprice + l_quantity / 200) / 8 as v from lineitem)
        select l_orderkey, l_linenumber, l_partkey, {_cents('v')} as v from t""",
    "dietary_tags": """select p_partkey as product_id, case when p_size < 10 then 'sans viande' when p_size < 20 then 'sans poisson,végétarien'
        when p_size < 30 then '' when p_size < 40 then 'sans porc' else '' end as tags from part""",
    "keyword_recommendable": """select p_partkey as product_id, case when p_brand = 'Brand#3' then true
        when p_size < 10 and not (p_size > 4) then false
        when p_type in ('SMALL', 'LARGE', 'PROMO') then false else true end as recommendable from part""",
    "override_cascade": """select p_partkey as product_id, case
        when p_brand in ('Brand#1', 'Brand#2', 'Brand#3') then 'sans_alcool'
        when p_brand in ('Brand#4', 'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9') then 'soft'
        when p_brand in ('Brand#10', 'Brand#11', 'Brand#12', 'Brand#13') then 'chaud' end as role from part""",
    "html_clean": f"""select page_id, {_squeeze(_unescape("regexp_replace(" + _unescape("html") + ", '<[^>]+>', ' ', 'g')"))} as text from pages""",
    "image_url": """select page_id, 'https://img.example/catalog/' || ltrim(regexp_extract(url, '^https?://[^/]+(/.*)$', 1), '/') as image_url from pages""",
    "status_map": "select o_orderkey, case when o_orderstatus = 'F' then 'active' else 'inactive' end as status from orders",
    "geo_bounds": """with t as (select c_custkey, case when c_mktsegment <> 'HOUSEHOLD' then c_acctbal / 40 end as lng,
            case when c_mktsegment <> 'MACHINERY' then cast(c_nationkey * 5 - 20 as double) end as lat from customer),
        u as (select *, lng between -180 and 180 and lat between -90 and 90 as inside from t)
        select c_custkey, case when inside then lng end as lng, case when inside then lat end as lat,
            lng is not null and lat is not null and not inside as outside from u""",
    "piece_summary": """with t as (select doc_id, list_filter(list_transform(string_split(text, chr(10)),
            lambda x: regexp_replace(x, '^[\\s\\x{85}\\x{a0}]+|[\\s\\x{85}\\x{a0}]+$', '', 'g')), lambda x: x <> '') as p from documents)
        select doc_id, array_to_string(p[1:8], ', ') || case when len(p) > 8 then ' (+' || (len(p) - 8) || ' autres)' else '' end as summary from t""",
    "prompt_lines": """select p_partkey as product_id, 'Nom: "' || p_name || '" | Département: "' || p_brand || '" | Catégories: [' ||
            case when p_size < 25 then p_type || ', ' || p_brand || ', a, b' else 'aucune' end || ']' ||
            case when p_size < 40 then ' | Contient: [' || replace(p_name, ' ', ', ') || ', a, b, c, d, e, f (+2 autres)]' else '' end as line,
        'Nom: "' || p_name || '"' || chr(10) || '   Ingrédients: ' || case when p_type = 'SMALL' then 'ABSENTS' else p_type end as diet
        from part""",
    "json_records": """select p_partkey as product_id, p_brand as department, case when p_size > 42 then null
        when p_size > 20 then cast(p_size as varchar) else p_size || '.0000' end as portions from part""",
    "composition_shape": """with t as (select *, unnest([0, 1, 2]) as place from part where p_type = 'LARGE')
        select p_partkey as product_id, 'T' as title, cast(place as bigint) as place,
            case place when 0 then p_name when 1 then p_brand else '' end as name,
            cast(case place when 1 then p_size else 1 end as bigint) as qty,
            case place when 1 then 'https://img.example/i.png' end as image_url from t""",
    "plateau_shape": """select p_partkey as product_id, p_type = 'MEDIUM' as composable,
            cast(case when p_type = 'MEDIUM' then p_size end as bigint) as qty, g as "group",
            case g when 'G' then '0-0' when 'H' then '2-0' end as code,
            case g when 'G' then p_name when 'H' then p_brand end as name,
            case g when 'G' then p_size + 0.5e0 end as extra_price,
            case when g = 'H' and p_size < 25 then 'lait' end as ingredients
        from (select *, unnest(case when p_type = 'MEDIUM' then ['G', 'H'] else [null] end) as g from part)""",
    "product_document": f"""with m as (select l_partkey, median(l_extendedprice) as v from lineitem group by all),
        t as (select *, {_NAME} as name, {_STEP} as menu_step, {_ROLE} as dish_role, p_type = 'MEDIUM' as composable from part left join m on l_partkey = p_partkey)
        select p_partkey as product_id, 'S' || p_partkey as sku, name,
            case when p_brand = 'Brand#25' then 'inactive' else 'active' end as status,
            case when p_size < 6 then ' Bundle ' else 'simple' end as type_id, menu_step, dish_role,
            cast(null as varchar) as drink_role,
            cast(case when p_type = 'PROMO' and p_size >= 20 then p_size * 10 end as bigint) as volume_ml,
            composable as is_composable, composable or p_size >= 6 or p_type = 'LARGE' as recommendable,
            cast(case when p_size <= 42 then p_size end as bigint) as persons,
            nullif({_word('name', "and w not in ('plateau', 'plateaux')")}, '') as family,
            {_cents('v')} as price_ref, p_brand as department, cast(case when p_size < 25 then 2 else 3 end as bigint) as delai_prepa,
            case when p_size < 30 then 'https://img.example/catalog/p/' || p_partkey || '.jpg' end as image_url,
            case when p_size < 20 then 'Barbecue,Mariage' else 'ALL' end as could_fit_event,
            case when p_size < 10 then 'sans porc' when p_size < 25 then 'végétarien,sans porc' else '' end as dietary_tags,
            case when p_size < 25 then 'vegan/lait/read/m1' else '' end as diet,
            p_size || '=' || p_type || ',x=' || p_brand as categories,
            cast(case when p_type = 'LARGE' then 3 end as bigint) as n_pieces,
            cast(case when p_type = 'MEDIUM' then 2 end as bigint) as n_groups,
            concat('{{"product_id":"', p_partkey, '","sku":"S', p_partkey, '","name":"', name, '","status":"',
                case when p_brand = 'Brand#25' then 'Désactivé' else 'Activé' end, '","type_id":"', case when p_size < 6 then ' Bundle ' else 'simple' end,
                '","nb_portion":', case when p_size > 42 then 'null' when p_size > 20 then cast(p_size as varchar) else concat('"', p_size, '.0000"') end,
                ',"weight":"', p_size * 10, '.0000","type_envie":', case when p_size < 10 then '"Sans Porc"'
                    when p_size < 25 then '["froid"," Végétarien ","SANS PORC","sans porc"]' when p_size < 40 then '[]' else 'null' end,
                ',"delai_prepa":', case when p_size < 25 then '"2"' else '3.0' end,
                ',"image":"', case when p_size < 30 then concat('//p/', p_partkey, '.jpg') else '' end, '","suppliers_department":"', p_brand,
                '","categories":[{{"category_id":', p_size, ',"category_name":"', p_type, '"}},{{"category_id":"x","category_name":"', p_brand, '"}}]',
                ',"ingredients":"&lt;b&gt;', p_name, '&lt;/b&gt;&amp;amp; sel"',
                case when p_type = 'LARGE' then concat(',"composition":{{"title":"T","pieces":["', p_name, '",{{"name":"', p_brand, '","qty":"', p_size,
                    '","image":"/i.png"}},{{"qty":0}},7]}}') else '' end,
                case when p_type = 'MEDIUM' then concat(',"composition_plateau":{{"title":"C","qty":"', p_size, '","groups":[{{"name":"G","pieces":[{{"code":"0-0","name":"',
                    p_name, '","price":"', p_size, '.5"}},{{"code":"0-1","disabled":" ON "}},9]}},{{"name":"E","pieces":[{{"code":"1-0","disabled":"on"}}]}},{{"name":"H","pieces":[{{"code":"2-0","name":"',
                    p_brand, '","price":0,"ingredients":"', case when p_size < 25 then 'lait' else '' end, '"}}]}},"x"]}}') else '' end, '}}') as raw
        from t""",
    "stored_products": """select p_partkey as product_id, case when p_brand = 'Brand#25' then 'inactive' else 'active' end as status,
            '2024-01-01 00:00:00' as ingested_at
        from part where p_type = 'MEDIUM' or p_size >= 6 or p_type = 'LARGE'""",
    "store_document": """with t as (select *, s_acctbal / 40 as x, cast(s_nationkey * 4 - 10 as double) as y from supplier)
        select s_suppkey as store_id, s_name as name, cast(null as varchar) as code, 'N' || s_nationkey as city,
            case when s_acctbal < 2000 then true when s_acctbal < 4000 then null else false end as is_active,
            false as withdrawal_store, s_nationkey < 12 as drive,
            case when x between -180 and 180 and y between -90 and 90 then x end as lng,
            case when x between -180 and 180 and y between -90 and 90 then y end as lat,
            case when s_nationkey < 20 then s_nationkey || ',75001' else '' end as lad_postcodes, '' as concepts,
            case when s_acctbal > 5000 then 'Boucherie,Pain' else '' end as curated_concepts from t""",
    "concepts_unpivot": """with days as (select user_id, cast(ts as date) as day, max(value) > 20 as active from events group by all),
        last as (select user_id, max(day) as day from days where active group by all)
        select user_id as store_id, string_agg(distinct event_type, ',' order by event_type) as concepts
        from events join last using (user_id) where cast(ts as date) = day group by all""",
    "label_reply_parse": f"""with {_BATCH}, t as (select p_partkey * 10 + place as product_id, case
            when p_type = 'SMALL' then ['Desserts', 'Boissons', 'Plats'][place]
            when p_type = 'PROMO' then ['Petit Déj', 'Plats', null][place]
            when p_type = 'LARGE' then ['Table & Déco', 'Plats', null][place] else 'Plats' end as value,
            case when p_type in ('SMALL', 'PROMO', 'LARGE') then 'model' else 'fallback' end as source from batches)
        select * from t where value is not null""",
    "event_tags": f"""with {_BATCH} select p_partkey * 10 + place as product_id, case
            when p_type = 'SMALL' then ['Barbecue,Mariage', 'ALL', 'ALL'][place]
            when p_type = 'PROMO' then ['ALL', 'ALL', 'Noël et Nouvel An,Pâques'][place]
            when p_type = 'LARGE' then [null, 'Spécial enfant', null][place] else 'ALL' end as tags,
            case when p_type in ('SMALL', 'PROMO', 'LARGE') then 'model' else 'fallback' end as source from batches""",
    "diet_parse": f"""with {_BATCH}, t as (select p_partkey * 10 + place as product_id, case
            when p_type = 'SMALL' then ['vegan', null, null][place]
            when p_type = 'PROMO' then [null, 'poisson', null][place]
            when p_type = 'LARGE' then ['viande', null, null][place] end as profile, case
            when p_type = 'SMALL' then ['lait', 'viande', ''][place]
            when p_type = 'PROMO' then ['poisson,viande', 'alcool,poisson', ''][place]
            when p_type = 'LARGE' then ['porc,viande', 'crustaces', null][place] else '' end as contains,
            case when p_type in ('SMALL', 'PROMO', 'LARGE') then 'model' else 'fallback' end as source from batches)
        select * from t where contains is not null""",
    "diet_stamp": "select p_partkey as product_id, 'vegan' as profile, 'read' as source, 'm1' as model from part where p_size < 25",
    "reply_fallback": f"""with {_BATCH}, t as (select p_partkey * 10 + place as product_id, case
                when p_type = 'SMALL' then ['vin', 'soft', null][place] when p_type = 'PROMO' then ['soft', null, 'chaud'][place]
                else 'soft' end as answer,
            case when p_size < 10 then 'chaud' when p_size < 20 then 'soft' end as forced, p_type in ('SMALL', 'PROMO') as good from batches)
        select product_id, coalesce(forced, answer, 'soft') as value,
            case when forced is not null then 'name' when good then 'model' else 'fallback' end as source,
            forced is not null and forced is distinct from answer as overridden from t""",
    "label_cache_split": f"""with {_FLAGGED} select doc_id as product_id, lang from documents d
        where not exists (select 1 from labels_of l where l.doc_id = d.doc_id and toxic = 0)""",
    "batch_numbering": """with t as (select doc_id, doc_id // 3200 as bucket,
            row_number() over (partition by doc_id // 3200 order by doc_id) - 1 as place from documents)
        select doc_id, bucket, place // 50 + 1 as batch, place % 50 + 1 as number from t""",
    "label_distribution": f"""with {_FLAGGED} select coalesce(step, 'unclassified') as label, count(*) as n
        from documents left join labels_of using (doc_id) group by all""",
    "unclassified_warning": f"""with {_FLAGGED} select 'unclassified' as label, count(*) as n
        from documents left join labels_of using (doc_id) where step is null having count(*) > 0""",
    "tag_distribution": """with t as (select unnest(['Barbecue', 'Mariage']) as label from part where p_size < 20)
        select label, count(*) as n from t group by all""",
    "label_inject": f"""with {_FLAGGED} select doc_id as product_id, lang, step as menu_step, cast(null as varchar) as dish_role,
        'ALL' as could_fit_event from documents left join labels_of using (doc_id)""",
    "enrich_steps": _enriched(
        """case when name like '%ring%' then 'Desserts' when name like '%plate%' then 'Plats' when name like '%bolt%' then 'Boissons'
            when name like '%gear%' then 'Sauces' when name like '%rod%' then 'Plats' end""", "Pains"),
    "enrich_roles": _enriched(
        "case when name like '%small%' or name like '%cold%' then 'side' else 'main' end", "side", "menu_step = 'Plats'"),
    "enrich_drinks": _enriched(
        """case when name like '%red%' then 'vin' when name like '%hot%' then 'chaud' when name like '%cold%' then 'eau' end""",
        "cidre", "menu_step = 'Boissons'", "'soft'"),
    "enrich_events": _enriched(
        """case when name like '%ring%' then '["Anniversaire","Mariage"]' else '["ALL"]' end""", '["Mariage"]'),
    "enrich_diets": _enriched(
        """case when name like '%hot%' then '{"profile":"viande","contains":["porc","viande"]}'
            when name like '%cold%' then '{"profile":null,"contains":["poisson"]}'
            else '{"profile":"vegetarien","contains":["lait","oeuf"]}' end""", '{"profile":"vegan","contains":[]}'),
    "enrich_retry": f"""with {_ITEMS}, answered as (select product_id, case when name like '%ring%' then 'Desserts' when name like '%plate%' then 'Plats'
            when name like '%bolt%' then 'Boissons' when name like '%gear%' then 'Sauces' when name like '%rod%' then 'Plats' end as value from items)
        select *, 'model' as source, cast(2 as bigint) as attempts, false as failed from answered where value is not null""",
    "label_save": f"""with old as (select p_partkey, 'Pains' as value, case when p_brand = 'Brand#1' then 'model' else 'fallback' end as source, 'm0' as model
            from part where p_brand in ('Brand#1', 'Brand#2')),
        new as (select p_partkey, {_STEP} as value from part where p_size > 20)
        select coalesce(new.p_partkey, old.p_partkey) as product_id, 'menu_step' as field,
            case when new.p_partkey is null then old.value else new.value end as value,
            case when new.p_partkey is null then old.source else 'model' end as source,
            case when new.p_partkey is null then old.model else 'm1' end as model
        from old full join new on old.p_partkey = new.p_partkey""",
    "label_counts": f"""with {_LABELS}
        select field, count(*) as n, count(*) filter (p_size > 40) as fallback, count(*) filter (p_brand = 'Brand#7') as overridden from labels_of group by all""",
    "field_distributions": f"""with {_LABELS}
        select field, value as label, count(*) as n from labels_of where field in ('menu_step', 'dish_role') group by all
        union all select 'could_fit_event', unnest(['Barbecue', 'Mariage']), count(*) from part where p_size < 20
        union all select 'predicted_diet', 'vegan', count(*) from part where p_size < 25""",
    "repair_stale": """with t as (select p_partkey as product_id, p_name as name, p_type from part)
        select product_id, case when p_type not in ('LARGE', 'SMALL') then p_type
            when name like '%ring%' then 'Desserts' when name like '%plate%' then 'Plats' when name like '%bolt%' then 'Boissons'
            when name like '%gear%' then 'Sauces' when name like '%rod%' then 'Plats'
            when p_type = 'LARGE' then 'Plateaux' else 'À côté' end as menu_step from t""",
    "missing_portions": f"""with {_PRODUCTS} select coalesce(menu_step, 'Non classé') as step, product_id, sku
        from products where status = 'active' and persons is null""",
    "gap_report": f"""with {_PRODUCTS}, t as (select menu_step, count(*) as n from products where status = 'active' and persons is null group by all)
        select row_number() over (order by n desc, menu_step nulls first) as position, coalesce(menu_step, 'Non classé') as step, n from t""",
    "grouped_report": f"""with {_PRODUCTS}, gaps as (select coalesce(menu_step, 'Non classé') as step, product_id, sku from products
            where status = 'active' and persons is null)
        select *, row_number() over (partition by step order by product_id) as position from gaps""",
    "stale_steps": """select p_type as step, cast(case p_type when 'SMALL' then 1 else 2 end as bigint) as position, count(*) as n
        from part where p_type in ('SMALL', 'LARGE', 'HUGE') group by all""",
    "field_presence": """with c as (select count(*) filter (p_size < 10) as f, count(*) filter (p_type = 'SMALL') as e, count(*) as total from part)
        select unnest(['persons_estimated', 'category_tags', 'allergens', 'allergen_tags', 'embed_text', 'is_food', 'curated_concept']) as field,
            unnest([0, 0, 0, 0, e, f, 0]) as n, total from c""",
    "any_field": """select p_partkey, case when p_size < 10 then p_name end as is_food, case when p_type = 'SMALL' then p_brand end as embed_text
        from part where p_size < 10 or p_type = 'SMALL'""",
    "snapshot_counts": f"""with {_PRODUCTS} select count(*) as total, count(*) filter (status = 'active') as active,
        count(*) filter (status = 'active' and menu_step is not null) as with_step,
        count(*) filter (persons is null) as no_portions from products""",
    "latest_export": """with t as (select o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') as month, o_orderpriority = '1-URGENT' as packed
            from orders where o_orderpriority not in ('5-LOW', '2-HIGH')),
        best as (select max(struct_pack(m := month, p := packed)) as b from t)
        select o_orderkey, o_custkey, concat('catalogue_products_', month, '-01.jsonl', case when packed then '.gz' else '' end) as file
        from t, best where month = b.m and packed = b.p""",
    "vector_records": """select cast(vec_id as varchar) as id, case when quality = 1 then 'Plats' else '' end as menu_step,
        case when label > 3 then 'active' else 'inactive' end as status, cast(len(embedding) as bigint) as width,
        cast(list_sum(list_transform(embedding, lambda v: cast(round(cast(v as double) * 1000000) as bigint))) as bigint) as total,
        cast(list_sum(list_transform(embedding, lambda v, i: i * cast(round(cast(v as double) * 1000000) as bigint))) as bigint) as weighted
        from embeddings left join labels on doc_id = vec_id where toxic is distinct from 1""",
    "embed_names": f"""with {_PRODUCTS} select cast(product_id as varchar) as id, menu_step, status, cast(length(name) as double) as chars,
        cast(length(name) - length(replace(name, ' ', '')) + 1 as double) as words,
        cast(length(name) - length(replace(name, 'e', '')) as double) as e
        from products where status = 'active' and menu_step not in ('Fromages', 'Desserts')""",
    "embed_counters": f"""with {_PRODUCTS} select count(*) as eligible, count(*) filter (menu_step = 'Desserts') as blank_name, cast(0 as bigint) as failed
        from products where status = 'active' and menu_step <> 'Fromages'""",
}
