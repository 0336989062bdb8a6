"""Word lists, rule tables and constants that results depend on."""

from __future__ import annotations

# ---- fixed values: cells a movement file may use for "no value" ---------------------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- fixed values: reasons and texts of the six validation rules, in rule order -----------
RULE_TEXTS = {
    "unknown_product": "product_id not found in core.products",
    "unknown_supplier": "supplier_id not found in core.suppliers",
    "missing_sale_price": "movement_type='sale' but unit_sale_price is missing or <= 0",
    "missing_purchase_price": "movement_type='purchase' but unit_purchase_price is missing or <= 0",
    "breakage_with_price": "movement_type='breakage' but prices are not NULL",
    "purchase_without_supplier": "movement_type='purchase' but supplier_id is NULL",
}

MOVEMENT_KINDS = ["sale", "purchase", "breakage"]
ZONES = ["left", "center", "right"]
SOURCE_SYSTEM = "simulated_api"

# ---- fixed values: store layout -----------------------------------------------------------
SHELVES, LEVELS, SLOTS = 45, 5, 3

# ---- fixed values: pseudonyms and price noise ---------------------------------------------
ID_SALT = "retail_project_2026"
ID_PREFIX = "COD_"
ID_DIGITS = 10
PRICE_STEPS = [-0.8, -0.7, -0.6, -0.5, -0.4, -0.3, -0.2, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
DESCRIPTION_LENGTH = 15

# ---- fixed values: departments of the product master --------------------------------------
SAMPLE_SHARES = {"MACELLERIA": 0.05, "FRUTTA E VERDURA": 0.3, "SA.FO": 0.3, "PANETTERIA": 1.0}
DROPPED_CATEGORIES = ["MANIFESTAZIONI", "MATERIALE DI CONSUMO", "RICORRENZE", "PASTICCERIA"]
COMPOSITE_VAT = "++"
RENAMED_CATEGORIES = {"BLS": "FRESCHI", "SA.FO": "GASTRONOMIA"}

# ---- fixed values: brands; the n-th (from 1) has the code B + three digits ------------------
BRANDS = [
    "barilla", "vivo barilla", "barilla bio", "barillabio", "de cecco", "dececco", "divella", "voiello", "garofalo",
    "rumo", "la molisana",
    "mulino bianco", "mulinobianco", "pavesi", "balocco", "colussi", "gentilini", "paneangeli", "cameo", "buitoni",
    "motta", "bauli",
    "ferrero", "nutella", "rocher", "kinder", "lindt", "perugina", "nestle", "nestlé", "kitkat", "kit kat", "milka",
    "ritter",
    "parmalat", "granarolo", "sterilgarda", "lattebusche", "vallelata", "galbani", "invernizzi", "nonno nanni",
    "valsoia", "polenghi",
    "rio mare", "riomare", "nostromo", "callipo", "cirio", "mutti", "star", "knorr", "heinz",
    "coca cola", "cocacola", "coca-cola", "pepsi", "fanta", "sprite", "red bull", "redbull", "monster", "schweppes",
    "san pellegrino", "sanpellegrino", "levissima", "ferrarelle", "uliveto", "lilia", "santanna", "sant'anna",
    "lauretana",
    "lipton", "twinings", "pompadour", "lavazza", "illy", "kimbo", "segafredo", "borbone",
    "dash", "ariel", "lenor", "vileda", "ace", "chanteclair", "sole", "ominobianco", "bio presto", "biopresto",
    "scottex", "tempo", "fox", "domopak", "cuki", "tenderly",
    "findus", "oro gel", "orogel", "bofrost", "4 salti", "quattro salti",
    "pringles", "lays", "lay's", "san carlo", "sancarlo", "amica chips",
    "heineken", "peroni", "moretti", "becks", "beck's", "bud", "budweiser",
    "finish", "calgon", "cif", "ajax", "lysoform", "vetril",
    "dove", "nivea", "loreal", "l'oréal", "pantene", "head shoulders", "head&shoulders", "gillette", "colgate",
    "elmex", "mentadent",
    "aia", "martini", "amadori",
    "melinda", "fatina", "ortoromi", "naturella",
    "maldera", "senfter",
    "starbucks", "montorsi", "beretta", "mamma emma", "zymil", "pro drink", "biraghi", "santa lucia", "kefir",
    "philadelphia",
    "parmareggio", "hopla", "muller", "plasmon",
]

# ---- fixed values: brands searched first, in this order, with their spellings --------------
BRAND_SPELLINGS = {
    "mulino bianco": ["mulino bianco", "mulinobianco", "m b", "mb"],
    "rio mare": ["rio mare", "riomare", "r mare"],
    "coca cola": ["coca cola", "cocacola", "coca-cola"],
    "san pellegrino": ["san pellegrino", "sanpellegrino"],
    "oro gel": ["oro gel", "orogel"],
    "san carlo": ["san carlo", "sancarlo"],
    "bio presto": ["bio presto", "biopresto"],
    "ominobianco": ["ominobianco", "omino bianco"],
    "aia": ["aia"],
    "martini": ["martini"],
    "melinda": ["melinda"],
    "fatina": ["fatina"],
    "ortoromi": ["ortoromi"],
    "naturella": ["naturella"],
    "maldera": ["maldera"],
    "senfter": ["senfter"],
    "amadori": ["amadori"],
    "starbucks": ["starbucks"],
    "valsoia": ["valsoia"],
    "montorsi": ["montorsi"],
    "beretta": ["beretta"],
    "mamma emma": ["mamma emma"],
    "zymil": ["zymil"],
    "biraghi": ["biraghi"],
    "santa lucia": ["s.lucia", "santa lucia", "s. lucia"],
    "pro drink": ["pro drink"],
    "kefir": ["kefir"],
    "philadelphia": ["philadelphia"],
    "parmareggio": ["parmareggio"],
    "hopla": ["hopla"],
    "muller": ["muller"],
    "plasmon": ["plasmon"],
}

# ---- fixed values: display names dealt out to brand codes in order --------------------------
BRAND_NAMES = [
    "Barilla", "De Cecco", "Voiello", "Delverde", "Rummo", "Nestlé", "Ferrero", "Kinder", "Nutella", "Tic Tac",
    "Mulino Bianco", "Pavesi", "Bistefan", "Galbusera", "Balocco", "Lavazza", "Illy", "Kimbo", "Segafredo",
    "Nescafé",
    "Galbani", "Parmalat", "Granarolo", "Yomo", "Danone", "Findus", "Bonduelle", "Valfrutta", "Cirio", "Mutti",
    "Buitoni", "Panzani", "Star", "Knorr", "Maggi", "Rio Mare", "Calvo", "Simmenthal", "Nostromo", "Bolton",
    "Heinz", "Kraft", "Hellmann's", "Philadelphia", "Kellogg's", "Riso Scotti", "Riso Gallo", "Curtiriso", "Scotti",
    "Vivo",
    "Coca-Cola", "Pepsi", "Sprite", "Fanta", "Red Bull", "San Pellegrino", "Ferrarelle", "Levissima", "Acqua Panna",
    "Uliveto",
    "Lipton", "Twinings", "Pompadour", "Yogi Tea", "Tetley", "L'Oréal", "Garnier", "Pantene", "Head & Shoulders",
    "Dove",
    "Nivea", "Neutrogena", "Maybelline", "Colgate", "Oral-B", "Gillette", "AXE", "Rexona", "Sebamed", "Bioderma",
    "Borotalco", "Roberts", "Lysoform", "Vidal", "Johnson", "Ariel", "Dash", "Lenor", "Fairy", "Flash",
    "Cif", "Domestos", "Ace", "Bref", "Candeggina Regina", "Scottex", "Regina", "Tempo", "Fazzolettini Soft",
    "Kleenex",
    "Perlana", "Svelto", "Coccolino", "Omino Bianco", "Bioil", "Beretta", "Rovagnati", "Fiorucci", "Negroni",
    "Levoni",
    "Rigamonti", "Citterio", "Salumificio Italia", "Calabrese", "Pini",
    "Casa Modena", "Mortadella Bologna", "Prosciutto San Daniele", "Culatello Podere", "Bresaola Rigamonti",
    "Milka", "Toblerone", "Lindt", "Baci Perugina", "Venchi", "Pringles", "Lay's", "Snack d'Or", "Amica Chips",
    "San Carlo",
    "Martini", "Campari", "Aperol", "Ramazzotti", "Montenegro", "Birra Moretti", "Peroni", "Heineken", "Corona",
    "Beck's",
    "Contadino", "Tavernello", "Bolla", "Riunite", "Zonin",
]

# ---- fixed values: rotation class and spoilage range per category ---------------------------
# category | rotation class | lowest | highest spoilage probability
CATEGORY_1_RULES = [
    ("SCATOLAME DOLCE", "medium", "0.001", "0.004"),
    ("SCATOLAME SALATO", "medium", "0.0005", "0.003"),
    ("BEVANDE", "medium", "0.0001", "0.002"),
    ("SURGELATI", "medium", "0.002", "0.008"),
    ("MACELLERIA", "high", "0.03", "0.08"),
    ("FRUTTA E VERDURA", "high", "0.04", "0.10"),
    ("PANETTERIA", "high", "0.05", "0.12"),
    ("CURA CASA", "medium", "0.0", "0.001"),
    ("CURA PERSONA", "low", "0.0", "0.001"),
    ("BAZAR LEGGERO", "low", "0.0", "0.0005"),
    ("FRESCHI", "medium", "0.003", "0.02"),
    ("GASTRONOMIA", "medium", "0.01", "0.04"),
]

CATEGORY_2_RULES = [
    ("ACQUA", "high", "0.0001", "0.0005"),
    ("BEVANDE GASSATE", "high", "0.0001", "0.001"),
    ("BEVANDE PIATTE", "high", "0.0001", "0.001"),
    ("PASTA", "high", "0.0005", "0.002"),
    ("LATTE E PANNA FRESCA", "high", "0.02", "0.05"),
    ("YOGURT", "medium", "0.02", "0.05"),
    ("FORMAGGI", "medium", "0.015", "0.04"),
    ("SALUMI", "medium", "0.015", "0.04"),
    ("LATTICINI UHT ED ASSIMILABILI", "medium", "0.001", "0.004"),
    ("LATTICINI UHT - PANNA E BESCIAMELLA", "medium", "0.001", "0.004"),
    ("CHAMPAGNE E SPUMANTI", "low", "0.0001", "0.0005"),
    ("VINO", "low", "0.0001", "0.0005"),
    ("APERITIVI", "low", "0.0001", "0.0005"),
    ("PANE E FOCACCE FROZEN", "medium", "0.01", "0.03"),
    ("TERZA E QUARTA GAMMA", "high", "0.04", "0.10"),
    ("MODULO REFRIGERATO", "medium", "0.02", "0.05"),
    ("PARAFARMACEUTICO", "low", "0.0", "0.0005"),
    ("PRIMA INFANZIA - PANNOLINI", "medium", "0.0", "0.0005"),
]

CATEGORY_3_RULES = [
    ("ACQUA NON GASSATA", "high", "0.0001", "0.0005"),
    ("ACQUA GASSATA", "high", "0.0001", "0.0005"),
    ("ACQUA EFFERVESCENTE NATURALE", "high", "0.0001", "0.0005"),
    ("LATTE UHT", "high", "0.001", "0.003"),
    ("MOZZARELLE", "high", "0.03", "0.06"),
    ("RICOTTA", "medium", "0.03", "0.06"),
    ("YOGURT INTERO", "medium", "0.02", "0.05"),
    ("PANE INDUSTRIALE E MEDIA E LUNGA CONSERVAZIONE", "medium", "0.01", "0.02"),
    ("PANINI", "high", "0.05", "0.12"),
    ("CIABATTE", "high", "0.05", "0.12"),
    ("PIZZE FOCACCE", "high", "0.05", "0.12"),
    ("MELE", "high", "0.03", "0.07"),
    ("BANANE", "high", "0.05", "0.10"),
    ("POMODORI", "high", "0.04", "0.08"),
    ("ZUCCHINE/ZUCCHE", "high", "0.04", "0.08"),
    ("LATTUGHE", "high", "0.06", "0.12"),
    ("TONNO SOTT'OLIO", "high", "0.0005", "0.002"),
    ("PASSATA DI POMODORO", "high", "0.0005", "0.002"),
    ("PELATI E POMODORINI", "medium", "0.0005", "0.002"),
    ("FAGIOLI CONSERVATI", "medium", "0.0005", "0.002"),
    ("LAVASTOVIGLIE", "medium", "0.0", "0.0005"),
    ("CANDEGGINA", "medium", "0.0", "0.0005"),
    ("AMMORBIDENTI", "medium", "0.0", "0.0005"),
    ("CHAMPAGNE E SPUMANTI", "low", "0.0001", "0.0005"),
]

DEFAULT_RULE = ("medium", "0.005", "0.02")


def brand_spellings() -> list[tuple[str, str]]:
    """(spelling, brand code) in the order they are searched; the first one found in a text wins."""
    code = {brand: f"B{n:03d}" for n, brand in enumerate(BRANDS, 1)}
    listed = dict(BRAND_SPELLINGS)
    for brand in BRANDS:
        listed.setdefault(brand, [brand])
    return [(spelling, code[brand]) for brand, spellings in listed.items() for spelling in spellings]
