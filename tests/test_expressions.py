"""Column expressions on single values."""

import random

import pytest
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import numbers as N
from larder.functions import product as P
from larder.functions import replies as A
from larder.functions import text as X


def column(spark, values, expression, kind="string"):
    """Results of an expression over a list of values, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    out = rows.select("i", expression(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(out, key=lambda r: r["i"])]


def test_whole_numbers_from_text(spark):
    given = ["750.0000", " 6 ", "-2.7", "1e3", "1_000", ".5", "5.", "+4"]
    assert column(spark, given, N.safe_int) == [750, 6, -2, 1000, 1000, 0, 5, 4]
    odd = ["1d", "0x10", "n/a", "", None, "inf", "nan", "1e400", "1__0", "--1", "1 2"]
    assert column(spark, odd, N.safe_int) == [None] * len(odd)


def test_persons(spark):
    given = ["11", "3.000", None, "0.0", "-7", "dix", "0.4"]
    assert column(spark, given, N.persons) == [11, 3, None, None, None, None, None]


def test_volume_only_for_drinks_and_from_200(spark):
    given = ["1500.00", "333", "12", "199", "200", "199.9", None, "litre", "0"]
    drinks = column(spark, given, lambda w: N.volume_ml(w, F.lit("Boissons")))
    assert drinks == [1500, 333, None, None, 200, None, None, None, None]
    assert column(spark, given, lambda w: N.volume_ml(w, F.lit("Plats"))) == [None] * len(given)


def test_cents_round_like_the_exact_binary_value(spark):
    rng = random.Random(7)
    given = [2.675, 1.005, 0.125, 0.375, 0.005, 1e-9, 0.0, 5e15, 2.0**46, 2.0**46 - 0.005, 1.115, 99.995]
    given += [0.125 + 2.0**-55, 0.125 - 2.0**-56, 0.005 + 2.0**-60]
    given += [rng.randrange(10**7) / 200 for _ in range(4000)]
    given += [rng.uniform(0, 2) for _ in range(500)]
    given += [-v for v in given[:50]]
    assert column(spark, given, N.round_cents, "double") == [round(v, 2) for v in given]
    assert column(spark, [None], N.round_cents, "double") == [None]


@pytest.mark.parametrize(
    "name, plain, skipping",
    [
        ("Pain surprise polaire - 24 toasts", "pain", "pain"),
        ("48 Petits fours", "fours", "fours"),
        ("Menu familial gratin pour 4 personnes", "gratin", "gratin"),
        ("Plateau apéro charcuterie", "plateau", "charcuterie"),
        ("Douzaine d'huîtres", "huîtres", "huîtres"),
        ("Coteaux-du-Layon - 75cl", "coteaux", "coteaux"),
        ("Trio de choux jambon comté", "choux", "choux"),
        ("(bio) 6 x 33cl Jus d’orange", "jus", "jus"),
        ("Eau de source", "eau", "eau"),
        ("2 kg de veau", "veau", "veau"),
        ("12 kgs", "kgs", "kgs"),
        ("4 pièces", "", None),
        ("L 12 de", "", None),
        ("", "", None),
        (None, "", None),
        ("Box plateau 3", "box", None),
    ],
)
def test_family(spark, name, plain, skipping):
    assert column(spark, [name], X.family_word) == [plain]
    assert column(spark, [name], X.family) == [skipping]


def test_fold_merges_spellings(spark):
    pairs = {
        "crêpes": "crepe", "Crèpes": "crepe", "éclairs": "eclair", "cœur": "coeur", "verrines": "verrine",
        "jus": "jus", "vins": "vins", "choux": "chou", "ﬁnes": "fine", "éclair": "eclair",
        "½": "1⁄2", "ＡＢＣ": "abc", "한글": "\u1112\u1161\u11ab\u1100\u1173\u11af",
    }
    assert column(spark, list(pairs), X.fold_word) == list(pairs.values())


def test_strip_and_squeeze_know_all_blanks(spark):
    given = ["  a\t b \x1c", "\n", "a　　b"]
    assert column(spark, given, X.strip) == ["a\t b", "", "a　　b"]
    assert column(spark, given, X.squeeze) == ["a b", "", "a b"]
    assert column(spark, given, X.is_blank) == [False, True, False]


def test_clean_html(spark):
    given = [
        "P&acirc;te <b>(eau,&nbsp;sel)</b>", "&lt;p&gt;cr&amp;eacute;me&lt;/p&gt;", "&amp;amp;eacute;", None, "a" * 800,
    ]
    got = column(spark, given, X.clean_html)
    assert got == ["Pâte (eau, sel)", "créme", "&eacute;", "", "a" * 700]
    whole = column(spark, given[-1:], lambda c: X.clean_html(c, max_chars=None))
    assert whole == ["a" * 800]


# Own names: each pattern before, inside and after a word, with accent, case and rule order.
DRINKS = {
    "Rosé Sans-Alcool du Midi": "sans_alcool",
    "Spritz sansalcool": "sans_alcool",
    "Thé glacé sans alcool": "sans_alcool",
    "CHAMPOMY cassis": "sans_alcool",
    "Deux eaux de montagne aromatisées": "soft",
    "EAU minérale AROMATISÉE": "soft",
    "Cadeau coloré aromatisé": None,
    "Eau servie dans une bouteille bien trop longue, aromatisée": None,
    "the glace fruits": "soft",
    "Petite Boisson au The": "soft",
    "ice-tea maison": "soft",
    "Icetea": "soft",
    "Deux thés noirs": "chaud",
    "Décafé": "chaud",
    "Cafetière": "chaud",
    "chicorée du Nord": "chaud",
    "Infusions du soir": "chaud",
    "Théorème": None,
    "Limonade artisanale": None,
}


def test_drink_names_that_decide_the_role(spark):
    assert column(spark, list(DRINKS), X.drink_role_by_name) == list(DRINKS.values())
    assert {r for _, r in vocab.DRINK_NAME_RULES} <= set(vocab.DRINK_ROLES)


def records(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    return rows.withColumn("record", F.parse_json("raw"))


def over(spark, texts, expression):
    out = records(spark, *texts).select("i", expression(F.col("record")).alias("y")).collect()
    return [r["y"] for r in sorted(out, key=lambda r: r["i"])]


def test_dietary_tags(spark):
    got = over(
        spark,
        [
            '{"type_envie":["végétarien","épicé","sans viande"]}',
            '{"type_envie":"végétarien"}',
            '{"type_envie":["  SANS POISSON","Sans Viande  "]}',
            '{"type_envie":["sans viande","sucré","sans viande"]}',
            '{"type_envie":["halal"]}',
            '{"type_envie":[]}',
            '{"other":1}',
            '{"type_envie":[{"a":1},"sans porc",null]}',
        ],
        P.dietary_tags,
    )
    assert got[0] == ["végétarien", "sans viande"] or sorted(got[0]) == ["sans viande", "végétarien"]
    assert got[1] == ["végétarien"]
    assert sorted(got[2]) == ["sans poisson", "sans viande"]
    assert got[3:] == [["sans viande"], [], [], [], ["sans porc"]]


def test_composable_and_recommendable(spark):
    groups = '"composition_plateau":{"groups":[{"pieces":[{"code":"7"}]}]}'
    cases = {
        '{"id":1,' + groups + "}": (True, True),
        '{"name":"Buffet A PRÉCISER",' + groups + "}": (True, True),
        '{"name":"Corbeille, fruits au choix"}': (False, False),
        '{"name":"Composez la corbeille"}': (False, False),
        '{"name":"Corbeille de saison","type_id":"simple"}': (False, True),
        '{"name":"Corbeille de saison","type_id":"BUNDLE"}': (False, False),
        '{"name":"Corbeille","type_id":"bundle","composition":{"pieces":[{"name":"Poire"}]}}': (False, True),
        '{"name":"Corbeille","type_id":"bundle","composition":{"pieces":[]}}': (False, False),
        '{"composition_plateau":{"groups":{}}}': (False, True),
        "{}": (False, True),
    }

    def both(r):
        from larder.functions import variants as V

        made = P.composable(r)
        ok = P.recommendable(V.text(r, "$.name"), V.text(r, "$.type_id"), made, P.has_pieces(r))
        return F.struct(made, ok)

    assert [tuple(x) for x in over(spark, cases, both)] == list(cases.values())


def test_composition(spark):
    got = over(
        spark,
        [
            '{"composition":{"title":"T","pieces":["a",{"name":"b","qty":"3.0","image":"//x.png"},'
            '{"qty":0},7,null,{"name":null,"qty":"n"},"5"]}}',
            '{"composition":{"pieces":[]}}',
            '{"composition":null}',
            '{"composition":{"pieces":[1]}}',
        ],
        lambda r: P.composition(r, "http://i"),
    )
    assert got[0].title == "T"
    assert [tuple(p) for p in got[0].pieces] == [
        ("a", 1, None), ("b", 3, "http://i/x.png"), ("", 1, None), (None, 1, None), ("5", 1, None),
    ]
    assert got[1] is None and got[2] is None
    assert (got[3].title, got[3].pieces) == ("", [])


def test_plateau_drops_switched_off_pieces_and_empty_groups(spark):
    got = over(
        spark,
        [
            '{"composition_plateau":{"qty":"6","groups":[{"name":"G","pieces":[{"code":"0-0","name":"n","price":"2.5",'
            '"ingredients":""},{"code":"0-1","disabled":" ON "},{"code":"0-2","price":0},{"price":"0"},3]},'
            '{"name":"E","pieces":[{"disabled":"on"}]},"x",{"pieces":null}]}}',
            '{"composition_plateau":{"groups":[{"pieces":[{"disabled":"on"}]}]}}',
            "{}",
        ],
        lambda r: F.struct(P.plateau(r, "b").alias("p"), P.composable(r).alias("c")),
    )
    plateau = got[0].p
    assert (plateau.title, plateau.qty, [g.name for g in plateau.groups]) == ("", 6, ["G"])
    pieces = plateau.groups[0].pieces
    assert [(p.code, p.name, p.extra_price, p.ingredients) for p in pieces] == [
        ("0-0", "n", 2.5, None), ("0-2", "", None, None), (None, "", 0.0, None),
    ]
    # All pieces off: nothing to show, yet still a composable product.
    assert got[1].p is None and got[1].c is True
    assert got[2].p is None and got[2].c is False


def test_image_and_geo(spark):
    assert column(spark, ["//a/b.jpg", "a", "", None], lambda c: P.image_url(c, "h")) == ["h/a/b.jpg", "h/a", None, None]
    rows = spark.createDataFrame(
        [("2.35", "48.85"), ("181", "0"), ("x", "1"), (None, "1"), (" -180 ", "90"), ("nan", "0")],
        "lng string, lat string",
    )
    got = rows.select(
        P.geo_point(F.col("lng"), F.col("lat")).alias("g"), P.geo_out_of_bounds(F.col("lng"), F.col("lat")).alias("o")
    ).collect()
    assert [r.g and r.g.coordinates for r in got] == [[2.35, 48.85], None, None, None, [-180.0, 90.0], None]
    assert [r.o for r in got] == [False, True, False, False, False, False]


def test_prompt_lines(spark):
    got = over(
        spark,
        ['{"composition":{"pieces":[" a ","",{"name":"b"},{"name":null},"c","d","e","f","g","h","i","j"]}}', "{}"],
        lambda r: P.piece_summary(P.piece_names(r)),
    )
    assert got == ["a, b, c, d, e, f, g, h (+2 autres)", ""]


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('{"1":"DESSERTS","2":" plats "}', {1: "Desserts", 2: "Plats"}),
        ('```json\n{"1":"Petit déj"}\n```', {1: "Petit Déj"}),
        ('```{"1":"pains"}``` thanks', {1: "Pains"}),
        ('{"1":"Pizza","Gratin":"Plats","1.5":"Plats"}', {1: "Plats"}),
        ('{" 2 ":"sauces","+3":["Sauces"]}', {2: "Sauces", 3: "Plats"}),
        ('{"1":null,"2":4}', {1: "Plats", 2: "Plats"}),
        ("{}", {}),
        ("not json", None),
        ('["Plats"]', None),
        (None, None),
    ],
)
def test_reply(spark, reply, expected):
    rows = spark.createDataFrame([(reply,)], "x string").select(A.answers(F.col("x")).alias("a"))
    read = F.transform(
        "a", lambda p: F.struct(p["number"], A.label_value(p["value"], vocab.STEPS, "Plats"))
    )
    got = rows.select(read.alias("r")).first().r
    assert (got if got is None else {n: v for n, v in got}) == expected


def test_events_and_diets(spark):
    events = {
        '["mariage","BARBECUE","Mariage"]': ["Barbecue", "Mariage"],
        '["Mariage","all"]': ["ALL"], "[]": ["ALL"], '"Mariage"': ["ALL"], '["?"]': ["ALL"], "null": ["ALL"],
    }
    assert over(spark, events, A.events_value) == list(events.values())
    diets = {
        '{"profil":"Vegan","contient":["LAIT","lait","?"]}': ("vegan", ["lait"]),
        '{"profil":"vegetarien","contient":["crustaces"]}': (None, ["crustaces"]),
        '{"profil":"poisson","contient":["viande"]}': (None, ["viande"]),
        '{"profil":"poisson","contient":["poisson"]}': ("poisson", ["poisson"]),
        '{"profil":"viande","contient":"porc"}': ("viande", []),
        '{"profil":null}': (None, []), '"vegan"': (None, []), "null": (None, []),
    }
    assert [tuple(d) for d in over(spark, diets, A.diet_value)] == list(diets.values())


def test_folding_over_all_planes(spark):
    import unicodedata

    rng = random.Random(31)
    points = [c for c in range(0xA1, 0x30000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) in ("Lo", "Ll", "Lm", "No", "So", "Mn")]
    words = ["".join(chr(rng.choice(points)) for _ in range(rng.randint(1, 3))) for _ in range(4000)] + ["\U0001d41c\U0001d42b\U0001d41e\U0001d429\U0001d41e", "\uac00\uac01"]

    def plain(word):
        flat = unicodedata.normalize("NFKD", word.replace("œ", "oe"))
        return "".join(c for c in flat if not unicodedata.combining(c))

    got = column(spark, words, X.fold_word)
    # Words that lower case changes are left out: case is another rule.
    wrong = [(w, g, plain(w)) for w, g in zip(words, got) if w.lower() == w and len(plain(w)) <= 4 and sorted(g) != sorted(plain(w))]
    assert wrong == []
