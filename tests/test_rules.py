"""The published limits, word lists and rules at their edges, written out once more and not taken from the rules."""

import pytest
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules

# value: label, on both sides of every limit
BANDS = {
    "VEHICLE_AGE_MAX": ("<=", {2: "New", 3: "Standard", 5: "Standard", 6: "Older", 10: "Older", 11: None}),
    "TRUCK_MATURITY_MAX": ("<=", {90: "New Truck", 91: "Established", 365: "Established", 366: None}),
    "SUSTAINABILITY_MAX": ("<=", {3: 80, 4: 60, 7: 60, 8: None}),
    "AGE_GROUP_BELOW": ("<", {24: "Gen Z", 25: "Millennial", 39: "Millennial", 40: "Gen X", 54: "Gen X", 55: None}),
    "TENURE_MAX": ("<=", {30: "New", 31: "Recent", 90: "Recent", 91: "Established", 365: "Established", 366: None}),
    "SERVICE_SPEED_MAX": ("<=", {3: "Very Fast", 4: "Fast", 5: "Fast", 6: "Standard", 8: "Standard", 9: "Slow",
                                 12: "Slow", 13: None}),
    "REVENUE_BELOW": ("<", {9.99: "Low Value", 10: "Medium Value", 24.99: "Medium Value", 25: "High Value",
                            49.99: "High Value", 50: None}),
    "SALES_TIER_MIN": (">=", {1000: "High Performer", 999: "Medium Performer", 100: "Medium Performer",
                              99: "Low Performer", 10: "Low Performer", 9: None}),
    "MARGIN_TIER_MIN": (">=", {70: "High Margin", 69.9: "Medium Margin", 50: "Medium Margin", 49.9: "Low Margin",
                               30: "Low Margin", 29.9: None}),
    "DIGITAL_SHARE_MIN": (">=", {80: "Digital Native", 79.9: "Digital Friendly", 50: "Digital Friendly",
                                 49.9: "Mixed Channel", 20: "Mixed Channel", 19.9: None}),
    "DISCOUNT_SHARE_MIN": (">=", {50: "High Price Sensitivity", 49.9: "Moderate Price Sensitivity",
                                  25: "Moderate Price Sensitivity", 24.9: None}),
    "VALUE_TIER_MIN": (">=", {500: "High Value", 499.9: "Medium Value", 200: "Medium Value", 199.9: "Low Value",
                              50: "Low Value", 49.9: None}),
    "CHURN_RISK_MAX": ("<=", {7: 0.0, 8: 0.1, 30: 0.1, 31: 0.3, 60: 0.3, 61: 0.6, 90: 0.6, 91: 0.8, 180: 0.8, 181: None}),
    "LOCATION_RANK_MAX": ("<=", {5: "Premium Location", 6: "High Performing", 15: "High Performing", 16: "Standard",
                                 30: "Standard", 31: None}),
}
SYNONYMS = {
    "COUNTRY_NAMES": {"UNITED STATES": "United States", "UK": "United Kingdom"},
    "REGIONS": {"US": "North America", "CA": "North America", "GB": "Europe", "FR": "Europe", "PL": "Europe",
                "IN": "Asia Pacific", "JP": "Asia Pacific", "KR": "Asia Pacific", "AU": "Australia"},
    "TIME_ZONES": {"US": "America/New_York", "CA": "America/Toronto", "GB": "Europe/London", "FR": "Europe/Paris",
                   "DE": "Europe/Berlin", "JP": "Asia/Tokyo", "AU": "Australia/Sydney"},
    "GENDERS": {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female", "O": "Other", "OTHER": "Other",
                "N": "Prefer not to say", "PREFER NOT TO SAY": "Prefer not to say"},
    "MARITAL": {"S": "Single", "SINGLE": "Single", "M": "Married", "MARRIED": "Married", "D": "Divorced",
                "DIVORCED": "Divorced", "W": "Widowed", "WIDOWED": "Widowed"},
    "CATEGORIES": {"MAIN": "Main Dish", "ENTREE": "Main Dish", "ENTREES": "Main Dish", "SIDE": "Side Dish",
                   "SIDES": "Side Dish", "DRINK": "Beverage", "DRINKS": "Beverage", "BEVERAGE": "Beverage",
                   "DESSERT": "Dessert", "DESSERTS": "Dessert", "APPETIZER": "Appetizer", "APPETIZERS": "Appetizer",
                   "STARTER": "Appetizer"},
    "CHANNELS": {"MOBILE": "Mobile App", "APP": "Mobile App", "MOBILE APP": "Mobile App", "WALK-UP": "Walk-up",
                 "WALKUP": "Walk-up", "WALK_UP": "Walk-up", "WALKIN": "Walk-up", "ONLINE": "Online", "WEB": "Online",
                 "WEBSITE": "Online", "PHONE": "Phone", "CALL": "Phone", "KIOSK": "Kiosk", "SELF-SERVICE": "Kiosk"},
    "SEASONS": {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 5: "Spring", 6: "Summer", 8: "Summer"},
}
# rules: (metrics, label)
CASES = {
    "SEGMENTS": [
        ({"recency": 30, "orders": 10, "spent": 200, "signup": 99}, "VIP"),
        ({"recency": 31, "orders": 10, "spent": 200, "signup": 99}, "Loyal"),
        ({"recency": 30, "orders": 9, "spent": 200, "signup": 99}, "Loyal"),
        ({"recency": 60, "orders": 5, "spent": 100, "signup": 99}, "Loyal"),
        ({"recency": 61, "orders": 5, "spent": 100, "signup": 99}, "Regular"),
        ({"recency": 90, "orders": 3, "spent": 0, "signup": 99}, "Regular"),
        ({"recency": 91, "orders": 3, "spent": 50, "signup": 99}, "At Risk"),
        ({"recency": 91, "orders": 3, "spent": 49, "signup": 30}, "New"),
        ({"recency": 1, "orders": 2, "spent": 0, "signup": 31}, "New"),
        ({"recency": 181, "orders": 3, "spent": 49, "signup": 31}, "Churned"),
        ({"recency": 180, "orders": 3, "spent": 49, "signup": 31}, None),
    ],
    "JOURNEY": [
        ({"orders": 0, "recency": 1, "gap": 1}, "Prospect"),
        ({"orders": 1, "recency": 1, "gap": 1}, "First Purchase"),
        ({"orders": 3, "recency": 90, "gap": 1}, "Early Adopter"),
        ({"orders": 4, "recency": 30, "gap": 99}, "Engaged"),
        ({"orders": 11, "recency": 31, "gap": 30}, "Loyal"),
        ({"orders": 10, "recency": 181, "gap": 30}, "Churned"),
        ({"orders": 10, "recency": 180, "gap": 30}, None),
    ],
    "ORDER_SIZES": [({"items": n}, label) for n, label in (
        (1, "Single Item"), (2, "Small"), (3, "Small"), (4, "Medium"), (6, "Medium"), (7, "Large"), (10, "Large"), (11, None))],
    "ITEM_CLASSES": [
        ({"sold": 500, "margin": 60}, "Star Performer"), ({"sold": 500, "margin": 59}, "Volume Driver"),
        ({"sold": 99, "margin": 60}, "Niche Premium"), ({"sold": 99, "margin": 29}, "Underperformer"),
        ({"sold": 100, "margin": 60}, None), ({"sold": 99, "margin": 30}, None),
    ],
    "MENU_MATRIX": [
        ({"margin": 60, "tier": "High Performer"}, "Star"), ({"margin": 60, "tier": "Low Performer"}, "Cash Cow"),
        ({"margin": 60, "tier": "New/Inactive"}, None), ({"margin": 39, "tier": "High Performer"}, "Loss Leader"),
        ({"margin": 40, "tier": "High Performer"}, None), ({"margin": 39, "tier": "New/Inactive"}, "Dog"),
        ({"margin": 39, "tier": "Medium Performer"}, None),
    ],
    "OPERATIONAL_CATEGORIES": [
        ({"days": 365, "status": "Active"}, "Established Performer"), ({"days": 364, "status": "Active"}, "Growing Operation"),
        ({"days": 90, "status": "Active"}, "Growing Operation"), ({"days": 89, "status": "Active"}, "New Launch"),
        ({"days": 0, "status": "Active"}, None), ({"days": 9, "status": "Planned"}, "Pre-Launch"),
    ],
}


def evaluated(spark, columns):
    return list(spark.range(1).select(*[F.coalesce(c.cast("string"), F.lit("-")).alias(f"c{i}") for i, c in enumerate(columns)]).first())


def shown(value):
    return "-" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(BANDS))
def test_bands(spark, name):
    op, edges = BANDS[name]
    got = evaluated(spark, [fn.band(F.lit(v), op, getattr(rules, name), F.lit(None)) for v in edges])
    assert got == [shown(label) for label in edges.values()]


@pytest.mark.parametrize("name", sorted(SYNONYMS))
def test_synonyms(spark, name):
    words = SYNONYMS[name]
    assert {w: label for label, ws in getattr(rules, name).items() for w in ws}.keys() >= words.keys()
    got = evaluated(spark, [fn.normalize(F.lit(w), getattr(rules, name), F.lit(None)) for w in words])
    assert got == list(words.values())
    if name != "SEASONS":
        assert sum(map(len, getattr(rules, name).values())) == len(words)


@pytest.mark.parametrize("name", sorted(CASES))
def test_rules(spark, name):
    got = evaluated(spark, [
        fn.classify(getattr(rules, name), F.lit(None), **{k: F.lit(v) for k, v in metrics.items()})
        for metrics, _ in CASES[name]
    ])
    assert got == [shown(label) for _, label in CASES[name]]


def test_single_limits():
    assert rules.MEAL_HOURS == [((6, 10), "Breakfast"), ((11, 14), "Lunch"), ((15, 17), "Snack"), ((18, 21), "Dinner")]
    assert (rules.MAX_QUANTITY, rules.RECENT_DAYS, rules.MENU_RECENT_DAYS, rules.NEVER_ORDERED_DAYS) == (99, 90, 30, 9999)
    assert (rules.DAYS_PER_YEAR, rules.PROJECTION_YEARS, rules.SINGLE_ORDER_FACTOR) == (365, 2, 1.5)
    assert rules.FISCAL_FIRST_MONTH == 4 and rules.UNKNOWN_KEY == "-1"
    assert [label for label, _ in rules.TREND] == ["Trending Up", "Stable", "Declining"]
    assert [float(share) for _, share in rules.TREND] == [0.3, 0.1, 0]
    assert rules.POTENTIAL_RATIO_MIN == [("1.2", 95), ("1.1", 85), ("0.9", 75), ("0.8", 65)]
