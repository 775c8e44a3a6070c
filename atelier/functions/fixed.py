"""Word lists, weights, patterns and tables that results depend on, in their natural order."""

# Words that speak for a page class, with their weights.
PAGE_WORDS = {
    "LEGEND": {"légende": 10, "legend": 10, "symboles": 8, "symbols": 8, "nomenclature": 6, "abréviations": 5, "abbreviations": 5},
    "PLAN": {"étage": 8, "etage": 8, "niveau": 8, "floor": 8, "level": 7, "sous-sol": 6, "rez-de-chaussée": 6, "rdc": 5, "mezzanine": 5, "toiture": 4, "roof": 4},
    "DETAIL": {"détail": 10, "detail": 10, "coupe": 8, "section": 8, "assemblage": 6, "assembly": 6, "agrandissement": 5, "enlargement": 5},
    "ELEVATION": {"élévation": 10, "elevation": 10, "façade": 8, "facade": 8, "vue": 4, "view": 4, "nord": 3, "sud": 3, "est": 3, "ouest": 3},
}
PAGE_CLASSES = ["LEGEND", "PLAN", "DETAIL", "ELEVATION", "OTHER"]
NUMBER_WEIGHT, NUMBER_MOST = 2, 20

# Room numbers, with the confidence of each form, in order of priority.
ROOM_NUMBERS = [(r"^\d{3}$", 1.0), (r"^[A-Z]-?\d{3}$", 1.0), (r"^\d{3}[A-Z]$", 0.95), (r"^[A-Z]\d{3}[A-Z]?$", 0.95), (r"^\d{2,4}$", 0.8)]

# Names of rooms on drawings, whole texts in any case.
ROOM_NAMES = [
    "CLASSE|CLASS", r"CORRIDOR|CORR\.?", r"S\.?D\.?B\.?|SALLE DE BAIN", r"W\.?C\.?|TOILETTE?S?", r"RANG\.?|RANGEMENT", r"MÉC\.?|MÉCANIQUE", r"ÉLEC\.?|ÉLECTRIQUE",
    r"CONCIERGERIE|CONC\.?", r"BUREAU|BUR\.?", r"SECRÉTARIAT|SECR\.?", r"DIRECTION|DIR\.?", r"VESTIAIRE|VEST\.?", r"CUISINE|CUIS\.?", r"GYMNASE|GYM\.?",
    r"BIBLIOTHÈQUE|BIBLIO\.?", "SALLE", "LOCAL", "ENTRÉE", "HALL", r"ESCALIER|ESC\.?", r"ASCENSEUR|ASC\.?",
]

# Labels of doors, on upper-case text.
DOOR_LABELS = [r"^P-?\d{1,3}[A-Z]?$", r"^P\.?\d{1,3}[A-Z]?$", r"^PORTE\s*\d+[A-Z]?$", r"^D-?\d{1,3}[A-Z]?$", r"^DOOR\s*\d+[A-Z]?$"]

# Reliability of extraction methods.
METHOD_WEIGHTS = {"ocr": 0.85, "table": 0.90, "cross_ref": 0.80, "inferred": 0.60, "manual": 1.00, "unknown": 0.50}

# Replacements in room names, in order.
NAME_REPLACEMENTS = [("W.C.", "WC"), ("W-C", "WC"), ("SALLE DE BAIN", "WC"), ("TOILETTE", "WC"), ("TOILETTES", "WC"), ("SALLE DE CLASSE", "CLASSE"), ("LOCAL DE CLASSE", "CLASSE"), ("RANGEMENT", "RANGEMENT"), ("REMISE", "RANGEMENT"), ("ENTREPOSAGE", "RANGEMENT")]

# Ladders from a room's name to its type; the first hit decides.
LADDER_PLAN = [
    (["CLASSE"], "CLASSE"), (["WC", "TOILETTE"], "WC"), (["CORRIDOR"], "CORRIDOR"), (["GYMNASE"], "GYMNASE"), (["RANGEMENT", "REMISE", "DÉPÔT"], "RANGEMENT"), (["BUREAU", "SECRÉTARIAT"], "BUREAU"),
    (["VESTIAIRE"], "VESTIAIRE"), (["ÉLECTRIQUE"], "TECHNIQUE"), (["MÉCANIQUE", "CHAUFFERIE"], "TECHNIQUE"), (["TECHNIQUE"], "TECHNIQUE"), (["CONCIERGERIE", "ENTRETIEN"], "SERVICE"), (["SERVICE DE GARDE"], "SERVICE"),
    (["ESCALIER"], "CIRCULATION"), (["VESTIBULE"], "CIRCULATION"), (["MULTIFONCTIONNELLE"], "SALLE"), (["SALLE"], "SALLE"), (["CONSULTATION", "ORTHO", "PSYCHO"], "BUREAU"), (["ALCÔVE"], "CLASSE"),
]
LADDER_TRUTH = [
    (["CLASSE", "MATERNELLE"], "CLASSE"), (["WC", "TOILETTE", "S.D.B", "SALLE DE BAIN"], "WC"), (["CORRIDOR"], "CORRIDOR"), (["GYMNASE"], "GYMNASE"), (["RANGEMENT", "REMISE", "DÉPÔT", "ENTREPOSAGE"], "RANGEMENT"), (["VESTIAIRE"], "VESTIAIRE"),
    (["ÉLECTRIQUE", "MÉCANIQUE", "CHAUFFERIE", "TECHNIQUE"], "TECHNIQUE"), (["CONCIERGERIE"], "SERVICE"), (["ESCALIER", "VESTIBULE"], "CIRCULATION"), (["BUREAU", "SECRÉTARIAT", "DIRECTION"], "BUREAU"), (["SERVICE DE GARDE"], "SERVICE"),
]
LADDER_COUNT = [
    (["CLASSE"], "CLASSE"), (["CORRIDOR"], "CORRIDOR"), (["WC", "TOILETTE"], "WC"), (["RANGEMENT", "REMISE"], "RANGEMENT"), (["ÉLECTRIQUE", "MÉCANIQUE", "CHAUFFERIE"], "TECHNIQUE"),
    (["CONCIERGERIE"], "SERVICE"), (["ESCALIER", "VESTIBULE"], "CIRCULATION"), (["VESTIAIRE"], "VESTIAIRE"), (["GYMNASE"], "GYMNASE"),
]
LADDER_INDEX = [
    (["MATERNELLE"], "CLASSE"), (["GARDE"], "CLASSE"), (["BIBLIOTHÈQUE", "INFORMATIQUE"], "CLASSE"), (["PROFESSEUR"], "BUREAU"), (["MÉCANIQUE"], "LOCAL MÉCANIQUE"), (["TECHNIQUE"], "LOCAL TECHNIQUE"), (["WC", "TOILETTE"], "TOILETTE"),
]

# Names that mean the same room.
SAME_NAMES = [["WC", "TOILETTES", "TOILETTE", "W.C.", "SALLE DE BAIN", "S.D.B."], ["RANGEMENT", "REMISE", "DÉPÔT", "ENTREPOSAGE"], ["TECHNIQUE", "LOCAL TECHNIQUE", "LOCAL MÉCANIQUE", "MÉCANIQUE"], ["ÉLECTRIQUE", "LOCAL ÉLECTRIQUE"]]

# Synonyms of search terms.
SYNONYMS = [
    ["local", "pièce", "salle", "room"], ["porte", "door"], ["fenêtre", "window"], ["dimension", "cote", "mesure", "taille"], ["superficie", "surface", "area", "pi²", "sqft"],
    ["classe", "class"], ["corridor", "couloir", "hall"], ["toilette", "salle de bain", "bathroom", "wc"], ["rangement", "storage", "entrepôt"],
]
GOLD_SYNONYMS = [
    ["local", "pièce", "salle", "room"], ["porte", "door"], ["corridor", "couloir", "hall", "passage"], ["toilette", "wc", "salle de bain"], ["classe", "class", "salle de classe"], ["dépôt", "rangement", "storage", "entrepôt"], ["bureau", "office"],
    ["gymnase", "gym"], ["bibliothèque", "library"], ["chaufferie", "mécanique", "mechanical", "boiler"], ["vestibule", "entrée", "sas", "entry"], ["maternelle", "kindergarten"], ["service de garde", "garde", "daycare"],
    ["professeurs", "enseignants", "teachers", "staff"], ["concierge", "janitor"],
]
QUESTION_PHRASES = r"\b(c'est quoi|quel est|où est|combien de|qu'est-ce que|what is|where is|how many)\b"
QUESTION_MARKS = r"[?,!.'\"()]"

# Words added to the search text of a verified room: (in the name, as the type, words).
SEARCH_WORDS = [
    (["CLASSE"], ["CLASSE"], ["classe", "class", "salle de classe"]), (["CORRIDOR"], ["CORRIDOR"], ["corridor", "couloir", "hall", "passage"]), (["WC"], ["WC"], ["toilette", "wc", "salle de bain", "bathroom"]), (["BUREAU"], ["BUREAU"], ["bureau", "office"]),
    (["DÉPÔT"], ["DÉPÔT"], ["dépôt", "rangement", "storage", "entrepôt"]), (["VESTIBULE", "SAS"], ["VESTIBULE", "SAS"], ["vestibule", "entrée", "sas", "entry"]), (["VESTIAIRE"], ["VESTIAIRE"], ["vestiaire", "cloakroom"]),
    (["CHAUFFERIE"], [], ["chaufferie", "mécanique", "mechanical", "boiler"]), (["BIBLIOTHÈQUE"], [], ["bibliothèque", "library"]), (["GYMNASE"], [], ["gymnase", "gym"]), (["CONCIERGE"], [], ["concierge", "janitor"]),
    (["ÉLECTRIQUE", "TÉLÉCOM"], [], ["électrique", "télécom", "technique", "electrical", "telecom"]), (["MATERNELLE"], [], ["maternelle", "kindergarten"]), (["SERVICE DE GARDE"], [], ["service de garde", "garde", "daycare"]),
    (["PROFESSEURS"], [], ["professeurs", "enseignants", "teachers", "staff"]), (["GICLEURS"], [], ["gicleurs", "sprinkler"]),
]
FLOOR_WORDS = {1: ["1er étage", "rez-de-chaussée", "premier"], 2: ["2e étage", "deuxième", "second"]}

# Patterns of room ids in questions, of questions that count and of those that list.
ASKED_ROOMS = [r"([ABC])-(\d{3}(?:-\d+)?(?:-[A-Z])?)", r"\b(\d{3}(?:-\d+)?(?:-[A-Z])?)\b", r"([ABC])-(\d{2,3})\b"]
ASKED_COUNT = r"combien\s+de\s+(\w+).*bloc\s+([abc])"
ASKED_LIST = r"(?:liste|tous)\s+(?:des|les)\s+(\w+)"

# Nouns of count and list questions.
QUESTION_NOUNS = {"classes": "CLASSE", "classe": "CLASSE", "corridors": "CORRIDOR", "corridor": "CORRIDOR", "bureaux": "BUREAU", "bureau": "BUREAU", "toilettes": "WC", "wc": "WC", "dépôts": "DÉPÔT", "dépôt": "DÉPÔT", "vestibules": "VESTIBULE", "vestibule": "VESTIBULE", "vestiaires": "VESTIAIRE", "vestiaire": "VESTIAIRE"}

# Words of specifications that name a room type.
TYPE_WORDS = {
    "CLASSE": r"classe[s]?|salle[s]?\s+de\s+classe|local\s+d['’]enseignement",
    "WC": r"toilette[s]?|salle[s]?\s+de\s+(?:bain|toilette)|douche[s]?|w\.?c\.?",
    "CORRIDOR": r"corridor[s]?|couloir[s]?",
    "GYMNASE": r"gymnase[s]?|sport",
    "RANGEMENT": r"rangement[s]?|dépôt[s]?|remise[s]?|entreposage|entrepôt",
    "BUREAU": r"bureau[x]?|administration|secrétariat",
    "VESTIAIRE": r"vestiaire[s]?",
    "TECHNIQUE": r"mécanique[s]?|électrique[s]?|technique[s]?|chaufferie|salle[s]?\s+mécanique|salle[s]?\s+électrique",
    "SERVICE": r"conciergerie[s]?|entretien|service\s+de\s+garde",
    "CIRCULATION": r"escalier[s]?|vestibule[s]?|hall[s]?|entrée[s]?",
    "SALLE": r"salle[s]?\s+(?:multifonctionnelle|polyvalente|communautaire|des?\s+professeur)|multifonctionnelle",
}

# Sections of finishes and the room types they cover.
FINISH_SECTIONS = {
    "09 21 16": ["CLASSE", "BUREAU", "SALLE", "CORRIDOR", "CIRCULATION", "AUTRE"],
    "09 22 16": ["CLASSE", "BUREAU", "SALLE", "CORRIDOR", "CIRCULATION"],
    "09 30 13": ["WC", "SERVICE"],
    "09 51 13": ["CLASSE", "BUREAU", "SALLE", "CORRIDOR"],
    "09 53 00": ["CLASSE", "BUREAU", "SALLE", "CORRIDOR", "CIRCULATION"],
    "09 65 19": ["CLASSE", "BUREAU", "CORRIDOR", "CIRCULATION", "SALLE"],
    "09 91 00": ["CLASSE", "BUREAU", "SALLE", "CORRIDOR", "CIRCULATION", "WC", "TECHNIQUE", "SERVICE", "RANGEMENT", "GYMNASE"],
    "10 21 20": ["WC"],
    "10 28 13": ["WC"],
    "10 51 13": ["VESTIAIRE", "GYMNASE"],
}

# Finishes expected by room type (wall, floor, ceiling).
EXPECTED_FINISHES = {
    "CLASSE": (["gypse", "peinture P02"], ["VCT (09 65 19)"], ["acoustique (09 51 13)"]),
    "WC": (["céramique (09 30 13)", "peinture P08"], ["céramique (09 30 13)"], ["gypse peint"]),
    "CORRIDOR": (["peinture P05"], ["VCT (09 65 19)"], ["acoustique (09 51 13)"]),
    "GYMNASE": (["peinture P01/P05"], ["spécifique sport"], ["acoustique ou structure apparente"]),
    "TECHNIQUE": (["peinture P05"], ["béton peint P06"], ["structure apparente"]),
    "BUREAU": (["gypse", "peinture P02"], ["VCT (09 65 19)"], ["acoustique (09 51 13)"]),
    "SERVICE": (["céramique ou peinture"], ["céramique ou VCT"], ["gypse peint"]),
    "RANGEMENT": (["peinture P05"], ["béton ou VCT"], ["gypse peint ou structure"]),
    "CIRCULATION": (["peinture P05"], ["VCT (09 65 19)"], ["acoustique (09 51 13)"]),
    "SALLE": (["gypse", "peinture P02"], ["VCT (09 65 19)"], ["acoustique (09 51 13)"]),
}

# Titles of the sections of finishes.
FINISH_TITLES = {
    "09 21 16": "Revêtement en plaques de plâtre",
    "09 22 16": "Ossatures métalliques non-porteuses",
    "09 30 13": "Carrelages de céramique",
    "09 51 13": "Éléments acoustiques pour plafonds",
    "09 53 00": "Plafonds suspendus",
    "09 65 19": "Revêtements de sols souples (VCT)",
    "09 91 00": "Peinturage",
    "10 21 20": "Compartiments pour salles de toilettes",
    "10 28 13": "Accessoires de salles de toilettes",
    "10 51 13": "Armoires-vestiaires métalliques",
}

# Paint systems: surface, room types, finish.
PAINT_SYSTEMS = {
    "P01": ("murs intérieurs en blocs de béton et en béton coulé", ["TECHNIQUE", "SERVICE"], "perle"),
    "P02": ("murs et plafonds intérieurs en panneaux de gypse", ["CLASSE", "BUREAU", "SALLE", "AUTRE"], "perle"),
    "P03": ("surfaces intérieures en métal ferreux apprêtées", [], "semi-brillant"),
    "P04": ("métal galvanisé ou zingué et tuyaux en cuivre", [], "semi-brillant"),
    "P05": ("salles mécaniques/électriques, locaux techniques, corridors, escaliers, vestibules, dépôts", ["TECHNIQUE", "CORRIDOR", "CIRCULATION", "RANGEMENT"], "satiné"),
    "P06": ("planchers intérieurs en béton", ["TECHNIQUE"], "lustré"),
    "P07": ("surfaces intérieures en bois", [], "semi-brillant"),
    "P08": ("toilettes et douches", ["WC"], "semi-lustré"),
}

# Pages of the drawing set: (page, plan, what it shows).
PLANS = [
    (0, "A-000", "Page de garde / index"),
    (1, "A-050", "Notes générales / légende"),
    (2, "A-060", "Notes et détails portes extérieures"),
    (3, "A-100", "Démolition RDC (Bloc A)"),
    (4, "A-101", "Démolition 2e étage (Bloc A)"),
    (5, "A-102", "Démolition agrandissement"),
    (6, "A-110", "Démolition RDC (Bloc B/C)"),
    (7, "A-111", "Démolition 2e étage (Bloc B/C)"),
    (8, "A-150", "Plan de construction RDC (Bloc A)"),
    (9, "A-151", "Plan de construction (Bloc B/C)"),
    (10, "A-152", "Plan de construction agrandissement"),
    (11, "A-200", "Plafonds démolition RDC"),
    (12, "A-201", "Plafonds démolition 2e étage"),
    (13, "A-250", "Plafonds construction RDC"),
    (14, "A-251", "Plafonds construction 2e étage"),
    (15, "A-300", "Agrandissement / détails"),
    (16, "A-350", "Détails supplémentaires"),
    (17, "A-400", "Détails construction"),
    (18, "A-401", "Détails construction (suite)"),
    (19, "A-500", "Coupes"),
    (20, "A-501", "Coupes (suite)"),
    (21, "A-502", "Détails fenêtres"),
    (22, "A-550", "Détails en plan"),
    (23, "A-600", "Élévations extérieures"),
    (24, "A-601", "Élévations extérieures (suite)"),
    (25, "A-650", "Plan agrandi"),
    (26, "A-651", "Plan agrandi (suite)"),
    (27, "A-700", "Plan Bloc B"),
    (28, "A-800", "Plan agrandi salles de bain"),
    (29, "A-900", "Plan des finis RDC"),
    (30, "A-901", "Plan des finis 2e étage"),
    (31, "A-910", "Élévations intérieures finis"),
    (32, "A-911", "Élévations intérieures finis (suite)"),
    (33, "A-912", "Élévations intérieures finis (suite 2)"),
    (34, "A-950", "Bordereau des portes"),
]
PREFERRED_PLANS = ["A-150", "A-151"]

# A section code of a specification, and the header that opens a section on a page.
CODE = r"\b(\d{2})[\s\-]+(\d{2})[\s\-]+(\d{2})\b"
HEADER = r"Section\s+(\d{2}\s+\d{2}\s+\d{2})"
NO_TITLE = r"^(?:Page|Centre|Réhabilitation|CSSST|\d)"

# References to rooms in specifications, and references that are standards.
ROOM_REFERENCE = r"(?iu)\b(?:(?:local|pièce|salle|classe|bureau)[\s\-]*(\d{3,})|([A-Z]{1,2}-?\d{3}[a-z]?)\b|(?:plan|dessin|drawing)\s+([A-Z]-?\d+))"
STANDARD_REFERENCE = r"(?iu)^(?:(?:CSA|ASTM|CAN|ISO|ANSI|NFPA|ULC)[\s\-]*[A-Z]?\d+|[A-Z]\d{3,5}|\d{4,})$"
LOCAL_REFERENCES = [
    (r"(?iu)\blocal\s*(\d{3}[A-Z]?)\b", 1), (r"\b([A-Z]-?\d{3}[A-Z]?)\b", 1), (r"(?iu)\bpièce\s*(\d{3}[A-Z]?)\b", 1), (r"(?iu)\bclasse\s*(\d{3}[A-Z]?)\b", 1), (r"(?iu)\bgymnase\b", 0), (r"(?iuU)\bsalle\s+(\d{3}[A-Z]?|\w+)\b", 1),
]

# Products. A maker and a product with a bar between; words that introduce a maker; a model; items of a list.
BAR_PRODUCT = r"([A-Z][A-Za-z.\-]+(?:\s+[A-Za-z&.\-]+)*?)\s*\|\s*([A-Z][A-Za-z0-9\s\-.]+)"
MAKER_INTRODUCTIONS = [
    r"(?imu)(?:fabricant|manufacturer|fournisseur)\s*[:\-]?\s*(.+?)(?:\.|$)", r"(?imu)(?:marque|brand)\s*[:\-]?\s*(.+?)(?:\.|$)", r"(?imu)(?:produit\s+de|product\s+by)\s+(.+?)(?:\.|$)", r"(?imu)(?:fabriqué\s+par|made\s+by)\s+(.+?)(?:\.|$)",
]
MODEL = r"(?iu)(?:modèle|model|série|series|type|no\.?|#)\s*[:\-]?\s*([A-Z0-9][\w\-.]{2,})"
LIST_MAKER = r"(?m)(?:^|\n)\s*[\-•*]\s*([A-Z][A-Za-z\s&]+?)(?:\s*\(|$|\n)"
NO_INTRODUCED = ["ou", "et", "le", "la", "les", "un", "une", "or", "and", "the", "a", "an", "équivalent", "equivalent", "approuvé", "approved"]
NO_LISTED = ["ou équivalent", "or equivalent", "section", "partie", "article", "note", "voir", "see", "référence"]

# What a text states about a product: pattern by name; the first group is the value, a dimension has three sides and a unit.
SPECS = {
    "dimension": r"(?iu)(\d+(?:[.,]\d+)?)\s*(?:x|×|par)\s*(\d+(?:[.,]\d+)?)(?:\s*(?:x|×|par)\s*(\d+(?:[.,]\d+)?))?\s*(mm|cm|m|po|pi|\"|')?",
    "thickness": r"(?iu)(?:épaisseur|thickness|épais\.?)\s*[:\-]?\s*(\d+(?:[.,]\d+)?)\s*(mm|cm|po|\")?",
    "color": r"(?iu)(?:couleur|color|fini|finish)\s*[:\-]?\s*([A-Za-zÀ-ÿ\s]+?)(?:\.|,|$)",
    "rating": r"(?iu)(?:classe|class|rating|type)\s*[:\-]?\s*([A-Z0-9]+)",
    "fire_rating": r"(?iu)(?:résistance\s+au\s+feu|fire\s+rating)\s*[:\-]?\s*(\d+(?:[.,]\d+)?\s*(?:h|hr|heure|hour)?)",
}

# The five older forms of products, in order of priority, with how sure each is; which group is the maker and which the model.
OLD_PRODUCTS = [
    ("pipe", r"([A-Z][A-Za-z.\-]+(?:\s+[A-Za-z&.\-]+)*?)\s*\|\s*([A-Za-z0-9][A-Za-z0-9\s\-.]{2,})", 1, 2, 0.95),
    ("de/of", r"(?m)([A-Z][A-Za-z0-9\-\s]{2,50}?)\s+(?:de|of)\s+([A-Z][A-Za-z\-\s]+?)(?:[,.)]|$|\s*\n)", 2, 1, 0.85),
    ("labeled", r"(?is)(?:Fabricant|Manufacturer)\s*[:\-]\s*([A-Z][A-Za-z\-\s.]{3,40}?)[\n,;].{0,150}?(?:Produit|Product|Modèle|Model|No\.?|Numéro)\s*[:\-]\s*([A-Za-z0-9][A-Za-z0-9\-\s.]{3,40}?)(?:[,;.)]|\s*\n)", 1, 2, 0.90),
    ("known_mfr", r"(?i)(?<!ou\s)(?<!or\s)(?<!et\s)\b(MAKERS)\b[\s:]+([A-Z][A-Za-z0-9\-\s]{3,50}?)(?:[,.]|\s+(?:ou|or|et|and)\s|\s*\n)", 1, 2, 0.80),
    ("telle_que", r"(?i)(?:telle?\s+que|tel\s+que|comme|such\s+as)\s+([A-Za-z0-9][A-Za-z0-9\-\s]{3,50}?)\s+de\s+([A-Z][A-Za-z\-\s]+?)(?:[,.]|$)", 2, 1, 0.75),
]
KNOWN_MAKERS = [
    "sherwin-williams", "sherwin williams", "benjamin moore", "dulux", "sico", "behr", "ppg", "pratt & lambert", "rust-oleum", "rust oleum", "cloverdale", "para", "mapei", "schluter", "laticrete", "custom", "armstrong", "tarkett", "forbo",
    "johnsonite", "nora", "altro", "mannington", "interface", "mohawk", "usg", "certainteed", "cgc", "rockfon", "owens corning", "johns manville", "rockwool", "roxul", "dow", "basf", "sika", "tremco", "henry", "w.r. meadows", "cetco", "grace",
    "carlisle", "firestone", "soprema", "iko", "gaf", "jeld-wen", "masonite", "therma-tru", "andersen", "pella", "marvin", "assa abloy", "stanley", "hager", "von duprin", "lcn", "dorma", "allegion", "daubois", "mortar net", "viance", "polyprep", "blok-lok",
    "trane", "carrier", "lennox", "daikin", "mitsubishi", "fujitsu", "kohler", "american standard", "moen", "delta", "grohe", "sloan", "leviton", "hubbell", "eaton", "schneider", "siemens", "abb", "densglass", "gyproc", "fiberock",
]
NO_OLD_PRODUCTS = ["ou", "et", "le", "la", "les", "de", "du", "des", "avant", "après", "selon", "avec", "sans", "pour", "équivalent", "equivalent", "approuvé", "approved", "produit", "référence", "reference", "section", "voir", "note", "page", "partie", "article", "minimum", "maximum", "couche", "couches", "fini"]
NO_OLD_MAKER_PARTS = ["avant", "après", "selon", "des ", "les ", "une ", "deux "]
NO_BAR_MAKERS = ["pvc", "abs", "hdpe", "type", "série", "serie", "class"]
OTHER_MAKERS = ["benjamin moore", "sherwin", "rust-oleum"]

# What no maker is called.
NO_MAKERS = ["ou", "et", "le", "la", "les", "un", "une", "de", "du", "des", "or", "and", "the", "a", "an", "of", "to", "équivalent", "equivalent", "approuvé", "approved", "produit", "product", "référence", "reference", "références", "avant", "après", "selon", "avec", "sans", "pour", "des matériaux", "avant de", "et de", "des granulats", "installations", "conditions", "recommandations"]
NO_MAKER_PARTS = ["avant", "après", "selon", "avec", "des ", "et de"]
PRODUCT_TYPES = [
    r"(?iu)(?:^|\s)(porte|door)s?\b",
    r"(?iu)(?:^|\s)(fenêtre|window)s?\b",
    r"(?iu)(?:^|\s)(peinture|paint)s?\b",
    r"(?iu)(?:^|\s)(plancher|flooring|floor)s?\b",
    r"(?iu)(?:^|\s)(plafond|ceiling)s?\b",
    r"(?iu)(?:^|\s)(isolation|insulation)\b",
    r"(?iu)(?:^|\s)(gypse|drywall|gyproc)\b",
    r"(?iu)(?:^|\s)(tuile|tile)s?\b",
    r"(?iu)(?:^|\s)(béton|concrete)\b",
    r"(?iu)(?:^|\s)(acier|steel)\b",
    r"(?iu)(?:^|\s)(bois|wood)\b",
    r"(?iu)(?:^|\s)(verre|glass)\b",
    r"(?iu)(?:^|\s)(quincaillerie|hardware)\b",
    r"(?iu)(?:^|\s)(membrane)\b",
    r"(?iu)(?:^|\s)(revêtement|cladding|siding)\b",
]
STANDARDS = ["CSA", "ASTM", "ANSI", "ISO", "NORME", "NORM"]

# The older index: sections that a room type requires and those it commonly has, titles of sections.
ROOM_SECTIONS = {
    "CLASSE": (["09 91 00", "09 51 13", "09 65 19"], ["09 21 16", "08 11 14", "08 71 00", "12 21 23"]),
    "CORRIDOR": (["09 91 00", "09 65 19", "03 54 01"], ["09 51 13", "10 26 10", "10 14 24"]),
    "GYMNASE": (["09 65 19", "09 91 00", "09 51 13"], ["06 10 00", "10 21 13", "10 26 10"]),
    "TOILETTE": (["09 30 13", "09 91 00", "10 21 20"], ["09 51 13", "08 11 14", "08 71 00"]),
    "WC": (["09 30 13", "09 91 00", "10 21 20"], ["09 51 13", "08 11 14", "08 71 00"]),
    "CONCIERGERIE": (["09 30 13", "09 91 00", "09 65 19"], ["10 28 13", "08 11 14"]),
    "RANGEMENT": (["09 91 00", "09 65 19"], ["06 40 00", "08 11 14"]),
    "BUREAU": (["09 91 00", "09 51 13", "09 65 19"], ["09 21 16", "08 11 14", "12 21 23"]),
    "VESTIAIRE": (["09 30 13", "09 91 00", "10 51 13"], ["09 51 13", "10 21 20"]),
    "ESCALIER": (["09 91 00", "03 54 01", "05 50 00"], ["09 65 19", "10 14 24"]),
    "LOCAL TECHNIQUE": (["09 91 00", "03 54 01"], ["08 11 14", "09 65 19"]),
    "LOCAL MÉCANIQUE": (["09 91 00", "03 54 01"], ["08 11 14", "07 21 16"]),
    "CHAUFFERIE": (["09 91 00", "03 54 01"], ["07 21 16", "08 11 14"]),
    "ÉLECTRIQUE": (["09 91 00", "03 54 01"], ["08 11 14"]),
    "VESTIBULE": (["09 65 19", "09 91 00", "12 48 16"], ["08 44 13", "09 51 13"]),
}
SECTION_TITLES = {
    "03 54 01": "Sous-finition truellée des planchers", "06 10 00": "Charpenterie", "06 20 00": "Menuiserie de finition", "06 40 00": "Menuiserie architecturale", "07 21 16": "Isolant en matelas", "07 42 13": "Panneaux muraux métalliques", "07 53 00": "Membrane de toiture",
    "07 62 00": "Solins et accessoires", "07 84 00": "Coupe-feu", "07 92 00": "Calfeutrage et scellants", "08 11 14": "Portes en acier", "08 14 16": "Portes en bois", "08 44 13": "Murs-rideaux vitrés", "08 51 13": "Fenêtres en aluminium", "08 71 00": "Quincaillerie de porte",
    "08 80 00": "Vitrerie", "08 80 50": "Vitrerie intérieure", "09 21 16": "Cloisons en panneaux de gypse", "09 22 16": "Doublages non structuraux", "09 30 13": "Carrelage de céramique", "09 51 13": "Plafonds acoustiques", "09 53 00": "Plafonds spéciaux", "09 65 19": "Revêtements de sol résilients",
    "09 91 00": "Peinture", "10 12 20": "Tableaux d'affichage", "10 14 24": "Signalisation", "10 21 13": "Panneaux spécialisés", "10 21 20": "Accessoires de toilettes", "10 26 10": "Protection murale", "10 28 10": "Accessoires de toilettes", "10 28 13": "Accessoires de conciergerie",
    "10 51 13": "Armoires-vestiaires", "12 21 23": "Stores déroulants", "12 48 16": "Grilles gratte-pieds",
}

# The older index: words and section numbers of kinds of material.
MATERIALS = {
    "peinture": (["peinture", "latex", "apprêt", "primer", "couche", "benjamin moore", "sherwin", "alkyde"], ["09 91"]),
    "plancher": (["plancher", "revêtement de sol", "VCT", "époxy", "vinyle", "linoleum", "résilient", "tuile"], ["09 65", "03 54"]),
    "plafond": (["plafond", "suspendu", "acoustique", "armstrong", "tuile", "dalle"], ["09 51", "09 53"]),
    "céramique": (["céramique", "carrelage", "carreau", "tuile", "porcelaine", "mosaïque"], ["09 30"]),
    "porte": (["porte", "cadre", "dormant", "battant", "coupe-feu"], ["08 11", "08 14"]),
    "fenêtre": (["fenêtre", "vitrage", "double vitrage", "châssis", "aluminium"], ["08 51", "08 44"]),
    "cloison": (["gypse", "cloison", "mur", "panneau", "drywall"], ["09 21", "09 22"]),
    "isolation": (["isolant", "isolation", "pare-vapeur", "laine", "polystyrène"], ["07 21"]),
    "quincaillerie": (["serrure", "penture", "ferme-porte", "barre panique", "poignée"], ["08 71"]),
    "accessoires": (["distributeur", "sèche-mains", "miroir", "crochet", "barre d'appui"], ["10 21", "10 28"]),
}

# Questions to the older index: sections and words of what is asked for, and makers.
ASKED_SECTIONS = {
    "peinture": ["09 91 00", "09 91 23", "09 90 00"], "plancher": ["09 65 00", "09 68 00", "09 64 00", "09 63 00", "09 62 00"], "porte": ["08 11 00", "08 14 00", "08 71 00", "08 12 00"], "fenêtre": ["08 51 00", "08 52 00", "08 53 00", "08 50 00"], "plafond": ["09 51 00", "09 54 00"],
    "mur": ["09 21 00", "09 22 00", "09 29 00", "04 22 00"], "céramique": ["09 30 00", "09 31 00"], "isolation": ["07 21 00", "07 22 00", "07 27 00"], "étanchéité": ["07 92 00", "07 90 00"], "toiture": ["07 50 00", "07 51 00", "07 52 00"], "acier": ["05 12 00", "05 21 00", "05 50 00"],
    "béton": ["03 30 00", "03 31 00"], "électricité": ["26 00 00", "26 05 00", "26 27 00"], "mécanique": ["23 00 00", "21 00 00"], "gicleurs": ["21 13 00", "21 13 13"],
}
ASKED_WORDS = {
    "peinture": ["peinture", "peindre", "peint", "latex", "apprêt", "primer", "couleur"], "plancher": ["plancher", "sol", "revêtement de sol", "flooring", "époxy", "VCT", "vinyle", "linoleum"], "porte": ["porte", "cadre", "serrure", "quincaillerie", "penture"],
    "fenêtre": ["fenêtre", "vitrage", "vitre", "châssis", "store"], "plafond": ["plafond", "tuile acoustique", "suspendu", "ceiling"], "mur": ["mur", "cloison", "gypse", "placoplâtre", "drywall"], "céramique": ["céramique", "carrelage", "carreau", "tuile", "porcelaine"],
    "isolation": ["isolation", "isolant", "thermique", "acoustique", "pare-vapeur"], "étanchéité": ["étanchéité", "scellant", "calfeutrage", "joint"],
}
ASKED_MAKERS = ["mapei", "benjamin moore", "sherwin", "armstrong", "tarkett", "certainteed", "cgc", "lafarge", "hilti", "sika", "tremco"]

# A reply about a room: forms of its id, of its name, and names that may stand anywhere, in order.
REPLY_IDS = [r"(?iu)ID\s*[:=]\s*([A-Z]?-?\d+[A-Za-z]?)", r"(?iu)Local\s+([A-Z]?-?\d+[A-Za-z]?)", r"(?iu)([A-Z]-\d{3}[A-Za-z]?)"]
REPLY_NAMES = [r"(?iu)NOM\s*[:=]\s*([A-ZÀÂÄÉÈÊËÏÎÔÙÛÜÇ\s'-]+)", r"(?iuU)(?:CLASSE|CORRIDOR|BUREAU|TOILETTE|RANGEMENT|SALLE)[S]?\s*([\w\s'-]*)"]
COMMON_NAMES = [
    "CLASSE", "CORRIDOR", "BUREAU", "TOILETTE", "TOILETTES", "RANGEMENT", "SALLE DE CLASSE", "CONCIERGERIE", "VESTIBULE", "GYMNASE", "BIBLIOTHÈQUE", "SECRÉTARIAT", "DIRECTION",
    "MÉCANIQUE", "ÉLECTRIQUE", "SALLE DES PROFESSEURS", "CUISINE", "CAFÉTÉRIA", "ESCALIER", "ASCENSEUR",
]

# What users are told.
NOT_FOUND = "Information non trouvée dans les documents vérifiés."
MADE_UP = "⚠️ Ce numéro de local n'existe PAS sur les plans architecturaux. Il a été identifié comme fabriqué."
