"""Word lists, patterns and mappings that decide the results."""

# Fixed values, in order of priority: an earlier pattern wins over a later one.
STREET_PATTERNS = [
    (r"(?:улица|(?<!\w)ул\.|(?<!\w)ул)\s+(.+)", "улица"),
    (r"(.+)\s+(?:улица|(?<!\w)ул\.|(?<!\w)ул)", "улица"),
    (r"(?:переулок|(?<!\w)пер\.|(?<!\w)пер)\s+(.+)", "переулок"),
    (r"(.+)\s+(?:переулок|(?<!\w)пер\.|(?<!\w)пер)", "переулок"),
    (r"(?:шоссе|ш\.)\s+(.+)", "шоссе"),
    (r"(.+)\s+(?:шоссе|(?<!\w)ш\.)", "шоссе"),
    (r"(?:аллея)\s+(.+)", "аллея"),
    (r"(.+)\s+(?:аллея)", "аллея"),
    (r"(?:проспект|пр\.)\s+(.+)", "проспект"),
    (r"(.+)\s+(?:проспект|пр\.)", "проспект"),
    (r"(?:площадь|пл\.)\s+(.+)", "площадь"),
    (r"(.+)\s+(?:площадь|пл\.)", "площадь"),
    (r"(?:бульвар)\s+(.+)", "бульвар"),
    (r"(.+)\s+(?:бульвар)", "бульвар"),
    (r"(?:проезд|пр\.)\s+(.+)", "проезд"),
    (r"(.+)\s+(?:проезд|пр\.)", "проезд"),
    (r"(?:тупик)\s+(.+)", "тупик"),
    (r"(.+)\s+(?:тупик)", "тупик"),
    (r"(?:набережная)\s+(.+)", "набережная"),
    (r"(.+)\s+(?:набережная)", "набережная"),
]

HOUSE_PATTERNS = [
    (r"(?:дом|(?<!\w)д\.|(?<!\w)д)\s+(.+)", "дом"),
    (r"(?:вл\.|владение)\s+(.+)", "владение"),
    (r"(?:участок)\s+(.+)", "участок"),
]

BUILDING_PATTERNS = [
    (r"(?:корпус|корп\.|к\.|(?<!\w)к)\s+(.+)", "корпус"),
    (r"(?:строение|(?<!\w)стр\.|(?<!\w)с\.|(?<!\w)стр|(?<!\w)с)\s+(.+)", "строение"),
    (r"(?:здание)\s+(.+)", "здание"),
]

# Fixed value: a venue name without its generic first word.
NAME_PATTERN = r"(?:ресторан |кафе )?(.+)"
NAME_QUOTES = '«»"'

# Whole-name corrections.
NAME_TYPOS = {"Eхtra Virgin": "Extra virgin", "ExtraVirgin": "Extra virgin"}

# The register categories kept, and the texts that mean "no phone".
VENUE_TYPES = ["кафе", "бар", "ресторан"]
NO_PHONE = "нет телефона"

# Characters deleted from a text besides digits.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~—«»"

# Dishes looked for in reviews.
DISHES = [
    "пицца", "паста", "бургер", "шаурма", "пельмень", "шашлык", "вино", "пиво", "коктейль", "суши", "ролл",
    "фастфуд", "рыба", "морепродукт", "краб", "креветка", "лосось", "салат", "цезарь", "стейк", "курица",
    "котлета", "суп", "гаспаччо", "кебаб", "тикка", "масала", "хотдог", "гренка",
]

# The lemmatiser's first parse of "суши" is the verb, so mentions are found under that lemma.
DISH_LEMMAS = {**{dish: dish for dish in DISHES if dish != "суши"}, "сушить": "суши"}

# Label scores per text, and the weight of each in the polarity.
SCORE_LABELS = ["negative", "positive", "neutral", "skip", "speech"]
POLARITY = {"positive": 1, "negative": -1}

# The label spellings of the two training sets (the misspelling is the data's own).
SENTIMENT_LABELS = {
    "rureviews": {"negative": -1, "positive": 1, "neautral": 0, "neutral": 0},
    "senteval2016": {"2": -1, "1": 1, "0": 0},
}

# Fixed value: Earth radius in metres used for distances.
EARTH_RADIUS = 6_367_000.0
