"""Column expressions that shape products and stores."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import variants as V
from larder.functions.numbers import safe_int, to_double
from larder.functions.text import strip


def image_url(path: Column, base: str) -> Column:
    """Absolute address of a relative media path; null when there is no path."""
    tail = F.regexp_replace(path, "^/+", "")
    return F.when(path != "", F.concat(F.lit(base), F.lit("/"), tail))


def status(raw: Column) -> Column:
    return F.when(raw == vocab.ACTIVE_STATUS, "active").otherwise("inactive")


def allowed_tags(tags: Column, allowed: tuple[str, ...] = vocab.DIETARY_TAGS) -> Column:
    """Tags of a list that are allowed, lower case, once each, in order; [] for null."""
    clean = F.transform(
        F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.lower(strip(t))
    )
    return F.array_distinct(F.filter(clean, lambda t: t.isin(*allowed)))


def dietary_tags(record: Column, path: str = "$.type_envie") -> Column:
    """Allowed tags of a field that holds a list or one bare string."""
    value = F.try_variant_get(record, path, "variant")
    listed = F.transform(V.items(record, path), lambda t: t.try_cast("string"))
    return allowed_tags(F.when(V.is_text(value), F.array(V.text(record, path))).otherwise(listed))


def composable(record: Column) -> Column:
    """A product the customer builds from structured groups; wording does not count."""
    return F.coalesce(F.size(V.items(record, "$.composition_plateau.groups")) > 0, F.lit(False))


def has_pieces(record: Column) -> Column:
    """True when the composition names anything."""
    listed = F.size(V.items(record, "$.composition.pieces")) > 0
    value = F.try_variant_get(record, "$.composition.pieces", "variant")
    bare = V.is_text(value) & (V.text(record, "$.composition.pieces") != "")
    return F.coalesce(listed, F.lit(False)) | F.coalesce(bare, F.lit(False))


def recommendable(
    name: Column, type_id: Column, is_composable: Column, names_pieces: Column
) -> Column:
    """False for a choice the catalogue cannot resolve: opaque bundles and choice wordings."""
    low = F.lower(F.coalesce(name, F.lit("")))
    wording = F.lit(False)
    for phrase in vocab.CHOICE_WORDINGS:
        wording = wording | F.contains(low, F.lit(phrase))
    bundle = F.lower(strip(F.coalesce(type_id, F.lit("")))) == "bundle"
    return F.when(is_composable, True).when(bundle & ~names_pieces, False).otherwise(~wording)


def composition(record: Column, image_base: str) -> Column:
    """Flat list of pieces; null when none is named."""

    def piece(p: Column) -> Column:
        qty = safe_int(V.text(p, "$.qty"))
        return F.struct(
            F.when(V.is_text(p), p.try_cast("string"))
            .otherwise(V.text_or(p, "$.name", ""))
            .alias("name"),
            F.when(qty != 0, qty).otherwise(F.lit(1).cast("bigint")).alias("qty"),
            image_url(V.text(p, "$.image"), image_base).alias("image_url"),
        )

    pieces = V.items(record, "$.composition.pieces")
    known = F.filter(pieces, lambda p: V.is_text(p) | V.is_object(p))
    return F.when(
        F.size(pieces) > 0,
        F.struct(
            V.text_or(record, "$.composition.title", "").alias("title"),
            F.transform(known, piece).alias("pieces"),
        ),
    )


def plateau(record: Column, image_base: str) -> Column:
    """Groups of pieces to choose from, switched-off pieces and empty groups left out."""

    def offered(p: Column) -> Column:
        off = F.lower(strip(F.coalesce(V.text(p, "$.disabled"), F.lit("")))) == "on"
        return V.is_object(p) & ~off

    def piece(p: Column) -> Column:
        price = F.try_variant_get(p, "$.price", "variant")
        amount = to_double(V.text(p, "$.price"))
        return F.struct(
            V.text(p, "$.code").alias("code"),
            V.text_or(p, "$.name", "").alias("name"),
            V.text(p, "$.conditionnement").alias("conditionnement"),
            image_url(V.text(p, "$.image"), image_base).alias("image_url"),
            F.when(V.is_text(price) | (amount != 0), amount).alias("extra_price"),
            F.nullif(V.text(p, "$.ingredients"), F.lit("")).alias("ingredients"),
        )

    def group(g: Column) -> Column:
        pieces = F.filter(V.items(g, "$.pieces"), offered)
        return F.struct(
            V.text_or(g, "$.name", "").alias("name"),
            F.transform(pieces, piece).alias("pieces"),
        )

    groups = F.filter(V.items(record, "$.composition_plateau.groups"), V.is_object)
    shaped = F.filter(F.transform(groups, group), lambda g: F.size(g["pieces"]) > 0)
    return F.when(
        F.size(shaped) > 0,
        F.struct(
            V.text_or(record, "$.composition_plateau.title", "").alias("title"),
            safe_int(V.text(record, "$.composition_plateau.qty")).alias("qty"),
            shaped.alias("groups"),
        ),
    )


def categories(record: Column, path: str = "$.categories") -> Column:
    """Categories as (id, name), in order; [] when there are none."""
    shaped = F.transform(
        V.items(record, path),
        lambda c: F.struct(
            F.variant_get(c, "$.category_id", "string").alias("id"),
            F.variant_get(c, "$.category_name", "string").alias("name"),
        ),
    )
    return F.coalesce(shaped, F.array().cast("array<struct<id:string,name:string>>"))


def geo_point(longitude: Column, latitude: Column) -> Column:
    """Point in [longitude, latitude] order; null unless both are numbers within bounds."""
    lng, lat = to_double(longitude), to_double(latitude)
    return F.when(
        lng.between(-180, 180) & lat.between(-90, 90),
        F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates")),
    )


def geo_out_of_bounds(longitude: Column, latitude: Column) -> Column:
    """Both are numbers, but no place on earth."""
    lng, lat = to_double(longitude), to_double(latitude)
    inside = lng.between(-180, 180) & lat.between(-90, 90)
    return lng.isNotNull() & lat.isNotNull() & ~inside


def piece_summary(names: Column, shown: int = vocab.MAX_PIECES_SHOWN) -> Column:
    """First pieces by name and how many more there are; "" when none has a name."""
    kept = F.filter(F.transform(names, strip), lambda n: n != "")
    kept = F.coalesce(kept, F.array().cast("array<string>"))
    more = F.when(
        F.size(kept) > shown,
        F.concat(F.lit(" (+"), (F.size(kept) - shown).cast("string"), F.lit(" autres)")),
    ).otherwise("")
    return F.concat(F.array_join(F.slice(kept, 1, shown), ", "), more)


def piece_names(record: Column) -> Column:
    """Names of the composition's pieces, whether written as text or as objects."""
    known = F.filter(
        V.items(record, "$.composition.pieces"), lambda p: V.is_text(p) | V.is_object(p)
    )
    return F.transform(
        known,
        lambda p: F.coalesce(
            F.when(V.is_text(p), p.try_cast("string")).otherwise(V.text(p, "$.name")), F.lit("")
        ),
    )


def product_line(
    name: Column, department: Column, category_names: Column, contents: Column
) -> Column:
    """One product as a line of a labelling prompt, without its number."""
    named = F.filter(category_names, lambda c: c.isNotNull() & (c != ""))
    shown = F.array_join(F.slice(named, 1, vocab.MAX_CATEGORIES_SHOWN), ", ")
    line = F.concat(
        F.lit('Nom: "'), F.coalesce(name, F.lit("")),
        F.lit('" | Département: "'), F.coalesce(department, F.lit("")),
        F.lit('" | Catégories: ['),
        F.when(F.size(named) > 0, shown).otherwise("aucune"),
        F.lit("]"),
    )
    return F.when(
        contents != "", F.concat(line, F.lit(" | Contient: ["), contents, F.lit("]"))
    ).otherwise(line)


def diet_line(name: Column, ingredients: Column) -> Column:
    """One product as two lines of the diet prompt, without its number."""
    return F.concat(
        F.lit('Nom: "'), F.coalesce(name, F.lit("")),
        F.lit('"\n   Ingrédients: '),
        F.coalesce(F.nullif(ingredients, F.lit("")), F.lit("ABSENTS")),
    )
