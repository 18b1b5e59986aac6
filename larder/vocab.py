"""Label vocabularies, word lists, limits and text patterns.

Everything in this module is a fixed value that results depend on. Patterns are in Java
regex syntax; ``WORD`` stands for the characters that count as part of a word.
"""

# --- Fixed values: labels -------------------------------------------------------------

ACTIVE_STATUS = "Activé"
STEPS = (
    "Apéritifs", "Entrées", "Plats", "Sauces", "Fromages",
    "Desserts", "Boissons", "Pains", "Petit Déj", "Table & Déco",
)
MAIN_STEP = "Plats"
DRINK_STEP = "Boissons"
STALE_STEPS = ("Plateaux", "À côté")
DISH_ROLES = ("main", "side")
DRINK_ROLES = (
    "eau", "soft", "vin", "petillant", "champagne", "biere",
    "cidre", "spiritueux", "aperitif", "chaud", "sans_alcool",
)
EVENTS = (
    "Anniversaire", "Noël et Nouvel An", "Mariage", "Pâques", "Repas en famille",
    "Naissance et Baptême", "Brunch et Petit Déjeuner", "Apéro Dînatoire",
    "Spécial enfant", "Barbecue", "Pique-nique", "Dîner en amoureux", "Pot de départ",
)
ALL_EVENTS = "ALL"
DIET_PROFILES = ("vegan", "vegetarien", "poisson", "viande")
DIET_CONTAINS = (
    "porc", "alcool", "crustaces", "poisson", "viande", "lait", "oeuf", "gelatine",
)
DIETARY_TAGS = ("sans porc", "sans viande", "sans poisson", "végétarien")

FALLBACK_STEP = "Plats"
FALLBACK_DISH_ROLE = "main"
FALLBACK_DRINK_ROLE = "soft"

UNCLASSIFIED = "unclassified"
UNCLASSIFIED_REPORT = "Non classé"

RETIRED_FIELDS = (
    "persons_estimated", "category_tags", "allergens", "allergen_tags",
    "embed_text", "is_food", "curated_concept",
)

# --- Fixed values: limits -------------------------------------------------------------

MIN_VOLUME_ML = 200
MAX_FAMILIES = 80
LABEL_BATCH = 50
EMBED_BATCH = 500
VECTOR_BATCH = 200
VECTOR_WIDTH = 1536
MAX_CATEGORIES_SHOWN = 4
MAX_PIECES_SHOWN = 8
MAX_INGREDIENT_CHARS = 700

# --- Fixed values: word lists ---------------------------------------------------------

CHOICE_WORDINGS = (
    "au choix", "à composer", "a composer", "composez", "à préciser", "a preciser",
)
STOP_WORDS = (
    "de", "du", "des", "la", "le", "les", "un", "une", "et", "au", "aux", "à", "a",
    "en", "pour", "avec", "sans", "sur", "dans", "d", "l", "the",
)
FORMAT_WORDS = (
    "mini", "minis", "maxi", "maxis", "demi", "demie",
    "petit", "petite", "petits", "petites", "grand", "grande", "grands", "grandes",
    "gros", "grosse", "assortiment", "assortiments", "coffret", "lot", "pack", "sachet",
    "boite", "boîte", "barquette", "plaque", "seau", "menu", "menus", "formule",
    "formules", "familial", "familiale", "duo", "duos", "trio", "trios", "quatuor",
    "douzaine", "douzaines",
)
CONTAINER_WORDS = (
    "plateau", "plateaux", "assiette", "assiettes", "planche", "planches", "box",
    "coffret", "panier", "paniers", "apéro", "apero", "apéritif", "aperitif",
    "apéritifs", "aperitifs",
)

# --- Fixed values: text patterns ------------------------------------------------------

WORD = r"[\p{L}\p{N}_]"
# Blanks of every kind as the inside of a class. Listed one by one: ranges are slower.
BLANK = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85 \p{Z}"
BLANKS = rf"[{BLANK}]+"

# Packaging noise of a product name, each replaced by a blank, in this order.
NAME_NOISE = (
    r"\([^)]*\)",
    r"(?d)[-–].*$",
    rf"(?iuU)\d(?<!{WORD}\d)\d*([.,]\d+)?[{BLANK}]*"
    r"(g|kg|ml|cl|l|cm|mm|pièces?|pieces?|parts?|personnes?|pers|toasts?|x)"
    rf"(?!{WORD})",
    r"[\"'’,.:;!?/&]",
)

# Drink names that decide the drink role by themselves: first match wins, order matters.
DRINK_NAME_RULES = (
    (rf"(?iu)sans[{BLANK}-]?alcool", "sans_alcool"),
    (r"(?iu)champomy", "sans_alcool"),
    (rf"(?iud)(?<!{WORD})eaux?(?!{WORD}).{{0,20}}aromatis", "soft"),
    (rf"(?iu)th[ée] glac|boisson au th[ée]|ice[{BLANK}-]?tea", "soft"),
    (rf"(?iu)(?<!{WORD})th[ée]s?(?!{WORD})|caf[ée]|chicor[ée]e|infusion", "chaud"),
)
