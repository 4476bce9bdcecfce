"""Labels, word lists, limits and formats.

They have to equal the published rules for results to agree, so they are listed here once, as
plain data, in the order in which they apply (the first match wins). A rule is
``(label, [(metric, operator, value), ...])`` whose conditions must all hold; a band is
``(limit, label)``.
"""

# ---------------------------------------------------------------- fixed values: keys, formats
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
UNKNOWN_KEY = "-1"
UNKNOWN_NUMBER = -1
NEVER_ORDERED_DAYS = 9999
DEFAULT_CURRENCY = "USD"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
NON_DIGITS = "[^0-9+]"
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
EARLIEST_BIRTHDAY = "1900-01-01"
MAX_QUANTITY = 99
PRICE_TOLERANCE = "0.01"
RECENT_DAYS = 90
MENU_RECENT_DAYS = 30

# ------------------------------------------------------------ fixed values: synonyms by label
COUNTRY_NAMES = {"United States": ["UNITED STATES"], "United Kingdom": ["UK"]}
REGIONS = {
    "North America": ["US", "CA"],
    "Europe": ["GB", "FR", "PL"],
    "Asia Pacific": ["IN", "JP", "KR"],
    "Australia": ["AU"],
}
TIME_ZONES = {
    "America/New_York": ["US"],
    "America/Toronto": ["CA"],
    "Europe/London": ["GB"],
    "Europe/Paris": ["FR"],
    "Europe/Berlin": ["DE"],
    "Asia/Tokyo": ["JP"],
    "Australia/Sydney": ["AU"],
}
LANGUAGES = {
    "English": ["EN", "ENG", "ENGLISH"],
    "Spanish": ["ES", "ESP", "SPANISH"],
    "French": ["FR", "FRA", "FRENCH"],
    "German": ["DE", "GER", "GERMAN"],
    "Japanese": ["JA", "JAP", "JAPANESE"],
}
GENDERS = {
    "Male": ["M", "MALE"],
    "Female": ["F", "FEMALE"],
    "Other": ["O", "OTHER"],
    "Prefer not to say": ["N", "PREFER NOT TO SAY"],
}
MARITAL = {
    "Single": ["S", "SINGLE"],
    "Married": ["M", "MARRIED"],
    "Divorced": ["D", "DIVORCED"],
    "Widowed": ["W", "WIDOWED"],
}
CATEGORIES = {
    "Main Dish": ["MAIN", "ENTREE", "ENTREES"],
    "Side Dish": ["SIDE", "SIDES"],
    "Beverage": ["DRINK", "DRINKS", "BEVERAGE"],
    "Dessert": ["DESSERT", "DESSERTS"],
    "Appetizer": ["APPETIZER", "APPETIZERS", "STARTER"],
}
CHANNELS = {
    "Mobile App": ["MOBILE", "APP", "MOBILE APP"],
    "Walk-up": ["WALK-UP", "WALKUP", "WALK_UP", "WALKIN"],
    "Online": ["ONLINE", "WEB", "WEBSITE"],
    "Phone": ["PHONE", "CALL"],
    "Kiosk": ["KIOSK", "SELF-SERVICE"],
}
CONTACT_PREFERENCES = {
    "Digital Only": ["Digital Native"],
    "Digital Preferred": ["Digital Friendly"],
    "Multi-Channel": ["Mixed Channel"],
}

# ------------------------------------------------------------------ fixed values: keyword lists
LOCATION_TYPES = [
    (["PARK"], "Park"),
    (["DOWNTOWN", "CITY CENTER"], "Downtown"),
    (["BUSINESS", "OFFICE"], "Business District"),
    (["UNIVERSITY", "COLLEGE"], "University"),
    (["MARKET", "FARMER"], "Market"),
    (["FESTIVAL", "EVENT"], "Event"),
]
FOOT_TRAFFIC = [
    (["DOWNTOWN", "CITY CENTER"], "High"),
    (["BUSINESS", "UNIVERSITY"], "Medium"),
    (["PARK", "MARKET"], "Medium"),
]
DIETS = {
    "is_vegetarian": ("vegetarian", ["VEGGIE", "VEGETARIAN"]),
    "is_vegan": ("vegan", ["VEGAN"]),
    "is_gluten_free": ("gluten_free", ["GLUTEN FREE", "GF"]),
}
NUTRIENTS = {
    "calories": "calories",
    "protein_grams": "protein_g",
    "carbs_grams": "carbs_g",
    "fat_grams": "fat_g",
    "sodium_mg": "sodium_mg",
}

# --------------------------------------------------- fixed values: hours, months, calendar words
MEAL_HOURS = [((6, 10), "Breakfast"), ((11, 14), "Lunch"), ((15, 17), "Snack"), ((18, 21), "Dinner")]
DAY_PARTS = [((0, 5), "Late Night"), ((6, 11), "Morning"), ((12, 17), "Afternoon"), ((18, 21), "Evening")]
PEAK_WINDOWS = {
    "breakfast_orders": ("06:00", "10:00"),
    "lunch_orders": ("12:00", "14:00"),
    "snack_orders": ("15:00", "17:00"),
    "dinner_orders": ("18:00", "21:00"),
}
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}
FISCAL_FIRST_MONTH = 4
HOLIDAYS = [((1, 1), "New Year's Day"), ((7, 4), "Independence Day"), ((12, 25), "Christmas Day")]

# --------------------------------------------- fixed values: bands (value <= or >= limit -> label)
VEHICLE_AGE_MAX = [(2, "New"), (5, "Standard"), (10, "Older")]
TRUCK_MATURITY_MAX = [(90, "New Truck"), (365, "Established")]
SUSTAINABILITY_MAX = [(3, 80), (7, 60)]
AGE_GROUP_BELOW = [(25, "Gen Z"), (40, "Millennial"), (55, "Gen X")]
TENURE_MAX = [(30, "New"), (90, "Recent"), (365, "Established")]
SERVICE_SPEED_MAX = [(3, "Very Fast"), (5, "Fast"), (8, "Standard"), (12, "Slow")]
REVENUE_BELOW = [(10, "Low Value"), (25, "Medium Value"), (50, "High Value")]
SALES_TIER_MIN = [(1000, "High Performer"), (100, "Medium Performer"), (10, "Low Performer")]
MARGIN_TIER_MIN = [(70, "High Margin"), (50, "Medium Margin"), (30, "Low Margin")]
DIGITAL_SHARE_MIN = [(80, "Digital Native"), (50, "Digital Friendly"), (20, "Mixed Channel")]
DISCOUNT_SHARE_MIN = [(50, "High Price Sensitivity"), (25, "Moderate Price Sensitivity")]
VALUE_TIER_MIN = [(500, "High Value"), (200, "Medium Value"), (50, "Low Value")]
CHURN_RISK_MAX = [(7, 0.0), (30, 0.1), (60, 0.3), (90, 0.6), (180, 0.8)]
POTENTIAL_RATIO_MIN = [("1.2", 95), ("1.1", 85), ("0.9", 75), ("0.8", 65)]
LOCATION_RANK_MAX = [(5, "Premium Location"), (15, "High Performing"), (30, "Standard")]

# ------------------------------------------------------------- fixed values: rules with conditions
ORDER_SIZES = [
    ("Single Item", [("items", "=", 1)]),
    ("Small", [("items", "<=", 3)]),
    ("Medium", [("items", "<=", 6)]),
    ("Large", [("items", "<=", 10)]),
]
BUSINESS_POTENTIAL = [
    (95, [("type", "=", "Downtown"), ("traffic", "=", "High")]),
    (90, [("type", "=", "Business District"), ("traffic", "=", "High")]),
    (85, [("type", "=", "University"), ("traffic", "=", "Medium")]),
    (80, [("type", "=", "Market"), ("traffic", "=", "Medium")]),
    (75, [("type", "=", "Park"), ("traffic", "=", "Medium")]),
    (70, [("type", "=", "Event")]),
]
OPERATIONAL_CATEGORIES = [
    ("Established Performer", [("days", ">=", 365), ("status", "=", "Active")]),
    ("Growing Operation", [("days", ">=", 90), ("status", "=", "Active")]),
    ("New Launch", [("days", ">", 0), ("status", "=", "Active")]),
    ("Pre-Launch", [("status", "=", "Planned")]),
]
MENU_MATRIX = [
    ("Star", [("margin", ">=", 60), ("tier", "=", "High Performer")]),
    ("Cash Cow", [("margin", ">=", 60), ("tier", "in", ["Medium Performer", "Low Performer"])]),
    ("Loss Leader", [("margin", "<", 40), ("tier", "=", "High Performer")]),
    ("Dog", [("margin", "<", 40), ("tier", "in", ["Low Performer", "New/Inactive"])]),
]
TREND = [("Trending Up", "0.3"), ("Stable", "0.1"), ("Declining", "0")]
SEGMENTS = [
    ("VIP", [("recency", "<=", 30), ("orders", ">=", 10), ("spent", ">=", 200)]),
    ("Loyal", [("orders", ">=", 5), ("spent", ">=", 100), ("recency", "<=", 60)]),
    ("Regular", [("orders", ">=", 3), ("recency", "<=", 90)]),
    ("At Risk", [("orders", ">=", 3), ("spent", ">=", 50), ("recency", ">", 90)]),
    ("New", [("signup", "<=", 30)]),
    ("New", [("orders", "<=", 2)]),
    ("Churned", [("recency", ">", 180)]),
]
JOURNEY = [
    ("Prospect", [("orders", "=", 0)]),
    ("First Purchase", [("orders", "=", 1)]),
    ("Early Adopter", [("orders", "<=", 3), ("recency", "<=", 90)]),
    ("Engaged", [("orders", ">", 3), ("recency", "<=", 30)]),
    ("Loyal", [("orders", ">", 10), ("gap", "<=", 30)]),
    ("Churned", [("recency", ">", 180)]),
]
ITEM_CLASSES = [
    ("Star Performer", [("sold", ">=", 500), ("margin", ">=", 60)]),
    ("Volume Driver", [("sold", ">=", 500), ("margin", "<", 60)]),
    ("Niche Premium", [("sold", "<", 100), ("margin", ">=", 60)]),
    ("Underperformer", [("sold", "<", 100), ("margin", "<", 30)]),
]

# ------------------------------------------------------- fixed values: lifetime value projection
DAYS_PER_YEAR = 365
PROJECTION_YEARS = 2
SINGLE_ORDER_FACTOR = 1.5
