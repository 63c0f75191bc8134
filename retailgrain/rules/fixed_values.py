"""The business lists that decide results. Edit or replace as data.

Site-specific codes (shop regions, company code, match labels) are not listed
here; the reports take them as arguments.
"""

from retailgrain.rules.tables import BucketBound, CityRule, MetricRule, ShopRule

# Supplier barcode -> own barcode, for articles whose names agree but codes do not.
BARCODE_EXCEPTIONS = {
    "007117194551": "711719455165",
    "007117194105": "711719410577",
    "007117197024": "711719702412",
    "001929400532": "192940053267",
    "001925639972": "192563997207",
    "004391700023": "43917000237",
}

# City names in matching order; the first one found in an address wins.
CITIES = (
    "Akmenė", "Alytus", "Anykščiai", "Ariogala", "Baltoji Vokė", "Birštonas", "Biržai", "Daugai",
    "Druskininkai", "Dūkštas", "Dusetos", "Eišiškės", "Elektrėnai", "Ežerėlis", "Gargždai", "Garliava",
    "Gelgaudiškis", "Grigiškės", "Ignalina", "Jieznas", "Jonava", "Joniškėlis", "Joniškis", "Jurbarkas",
    "Kaišiadorys", "Kalvarija", "Kaunas", "Kavarskas", "Kazlų Rūda", "Kėdainiai", "Kelmė", "Kybartai",
    "Klaipėda", "Kretinga", "Kudirkos Naumiestis", "Kupiškis", "Kuršėnai", "Lazdijai", "Lentvaris",
    "Linkuva", "Marijampolė", "Mažeikiai", "Molėtai", "Naujoji Akmenė", "Nemenčinė", "Neringa", "Nida",
    "Obeliai", "Pabradė", "Pagėgiai", "Pakruojis", "Palanga", "Pandėlys", "Panemuzė", "Panevėžys",
    "Pasvalys", "Plungė", "Priekulė", "Prienai", "Radviliškis", "Ramygala", "Raseiniai", "Rietavas",
    "Rokiškis", "Rūdiškės", "Salantai", "Seda", "Simnas", "Skaudvilė", "Skuodas", "Smalininkai",
    "Subačius", "Šakiai", "Šalčininkai", "Šeduva", "Šiauliai", "Šilalė", "Šilutė", "Širvintos",
    "Švenčionėliai", "Švenčionys", "Tauragė", "Telšiai", "Tytuvėnai", "Trakai", "Troškūnai", "Ukmergė",
    "Utena", "Užventis", "Vabalninkas", "Varėna", "Varniai", "Veisiejai", "Venta", "Viekšniai", "Vievis",
    "Vilkaviškis", "Vilkija", "Vilnius", "Virbalis", "Visaginas", "Zarasai", "Žagarė", "Žiežmariai",
)
OTHER_CITIES = "Kiti miestai"

# Pick-up shops as (address, city, city must also occur, address must be equal).
SHOPS = (
    ("Ukmergės g. 240", "Vilnius", False, False),
    ("Žirmūnų g. 64", "Vilnius", False, False),
    ("Ozo g. 18", "Vilnius", False, False),
    ("Upės g. 9", "Vilnius", False, False),
    ("Ozo g. 25", "Vilnius", False, False),
    ("Ukmergės g. 369", "Vilnius", False, False),
    ("Savanorių pr. 206", "Kaunas", False, False),
    ("Karaliaus Mindaugo pr. 49", "Kaunas", False, False),
    ("Islandijos pl. 32", "Kaunas", False, False),
    ("Jonavos g. 60", "Kaunas", False, False),
    ("Taikos pr. 64", "Klaipėda", False, False),
    ("Klaipėdos g. 143", "Panevėžys", False, False),
    ("Aido g. 8", "Šiauliai", False, False),
    ("Ūdrijos g. 1", "Alytus", False, False),
    ("Čiurlionio g. 55", "Druskininkai", False, False),
    ("Basanavičiaus g. 93", "Kėdainiai", False, False),
    ("S.Dariaus ir S.Girėno g. 3A", "Marijampolė", False, False),
    ("Laisvės g. 7 ", "Mažeikiai", False, False),
    ("Vilniaus g. 126", "Raseiniai", False, False),
    ("Respublikos g. 106", "Rokiškis", False, False),
    ("Dariaus ir Girėno g. 9", "Tauragė", False, False),
    ("Kęstučio g. 20-1", "Telšiai", False, False),
    ("Aušros g. 21", "Utena", False, False),
    ("Baranausko g. 44", "Utena", False, False),
    ("Kęstučio g. 2", "Biržai", False, False),
    ("Basanavičiaus g. 6", "Jonava", True, False),
    ("Algirdo g. 1A, Jurbarkas - PC Maxima . ", "Jurbarkas", False, True),
    ("Žaltakalnio g. 20A", "Plungė", True, False),
    ("Vytauto g. 17B", "Prienai", True, False),
    ("Tilžės g. 109", "Šiauliai", False, False),
    ("J.Basanavičiaus g. 3", "Panevėžys", True, False),
    ("Žemaitijos g. 38", "Mažeikiai", False, False),
    ("V. Kudirkos g. 3", "Marijampolė", True, False),
)
# Normalized delivery names that count as picked up in a shop.
PICKUP_DELIVERIES = ("atsiemimas parduotuveje", "atsiemimas parduotuve", "savitarna")

# The status of orders that are left out, and the label parts.
UNPAID_STATUS = "wait_payment"
LABEL_JOINER = " iki "

# Weekly metrics as (name, field, op, values, compare normalized).
METRICS = (
    ("Gauta užsakymų", None, "any", (), False),
    ("Atšauktų", "order_status", "in", ("canceled",), False),
    ("Eksportuoti", "order_status", "in", ("ORDEFOLDER_PREPARING",), False),
    ("Paruošta atsiėmimui", "order_status", "in", ("holded", "ORDEFOLDER_READYTOTAKE"), False),
    ("Nauji", "order_status", "in", ("processing",), False),
    ("Laukia apmokėjimo", "order_status", "in", ("wait_payment",), False),
    ("Užbaigti", "order_status", "in", ("complete", "ORDEFOLDER_COMPLETE"), False),
    ("Skubus į namus", "delivery", "in", ("LP Express",), False),
    ("Skubus C&C", "delivery", "in", ("atsiemimas parduotuve ", "atsiemimas parduotuveje"), False),
    ("Parduotuvėms perduota po darbo valandų", None, "any", (), False),
    ("Atsiėmimas parduotuvėje", "delivery", "in", ("atsiemimas parduotuveje",), False),
    ("Pristatymas nurodytu adresu ", "delivery", "in", ("pristatymas i namus",), True),
    ("Omniva", "delivery", "contains", ("omniva",), True),
    ("LP Express", "delivery", "in", ("LP Express",), False),
    ("DPD terminalas", "delivery", "in", ("DPD terminalas",), False),
    ("Savitarna", "delivery", "in", ("DPD terminalas",), False),
)

# Price buckets as (upper bound inclusive, label); no bound on the last.
PRICE_BUCKETS = (
    (50.0, "(0) 0 iki 50 Eur"),
    (100.0, "(1) 51 iki 100 Eur"),
    (180.0, "(2) 101 iki 180 Eur"),
    (200.0, "(3) 181 iki 200 Eur"),
    (250.0, "(4) 201 iki 250 Eur"),
    (1000.0, "(5) 251 iki 1000 Eur"),
    (None, "(6) 1000 ir daugiau Eur"),
)

# Quantity buckets and the label of anything else.
QUANTITY_BUCKETS = (
    BucketBound(0, "(0) Viena prekė", 1.0, 1.0, lower_inclusive=True),
    BucketBound(1, "(1) Dvi prekės", 2.0, 2.0, lower_inclusive=True),
    BucketBound(2, "(2) Nuo 3 iki 5 prekių", 2.0, 5.0),
    BucketBound(3, "(3) 6 ir daugiau preki7", 5.0, None),
)
QUANTITY_OTHER = "Error"

# Warehouse columns of the order cube, all nullable.
CUBE_COLUMNS = (
    ("Savaite", "bigint"),
    ("Savaites_xx_xx", "string"),
    ("Eshop", "string"),
    ("Uzsakymo_busena", "string"),
    ("Miestas", "string"),
    ("Atsiemimas", "string"),
    ("Preke", "string"),
    ("PriceBucket", "string"),
    ("QuantityBucket", "string"),
    ("Galutine_kaina", "double"),
    ("Kiekis_uzsakymu", "double"),
    ("Apsipirkimu_kiekis", "double"),
    ("Bendra_suma", "double"),
)

# Characters the text cleaner removes.
SPECIAL_CHARACTERS = ",:\t\n\a\b\f\r\v'`~\"+/?%!&*^$@#."

# Channel names of the order source by company id.
CHANNEL_BY_COMPANY = {1000: "TC"}
CHANNEL_OTHER = "EU"

# City groups of the sales report, searched in the shop name.
CITY_GROUPS = (("vilnius", "Vilnius"), ("kaunas", "Kaunas"))


def city_rules() -> list[CityRule]:
    return [CityRule(i, name, name) for i, name in enumerate(CITIES)]


def shop_rules() -> list[ShopRule]:
    return [ShopRule(i, *row) for i, row in enumerate(SHOPS)]


def metric_rules() -> list[MetricRule]:
    return [MetricRule(*row) for row in METRICS]


def price_buckets() -> list[BucketBound]:
    lower = [None, *(upper for upper, _ in PRICE_BUCKETS)]
    return [BucketBound(i, label, lower[i], upper) for i, (upper, label) in enumerate(PRICE_BUCKETS)]
