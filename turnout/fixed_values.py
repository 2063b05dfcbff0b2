"""Spellings, codes and parameters that results depend on.

They are part of the data contract, not logic; the functions that use them are
in ``turnout.functions`` and ``turnout.operators``.
"""

# -- fixed values: cleaning ------------------------------------------------

DEFAULT_DISTANCE = "Variable-SS"
DEFAULT_GENDER = "Other"
DEFAULT_TSHIRT = "N"
DEFAULT_HOODIE = "N"
DEFAULT_SERIES = 0

# miles of a distance whose own miles are missing; the default distance has none
DISTANCE_MILES = {
    "1/2 Marathon": 13.0,
    "Half Marathon early start": 13.0,
    "5k early start": 3.0,
    "5 Mile late start": 5.0,
    "10k early start": 6.0,
    "Half Marathon late start": 13.0,
    "22 mile": 22.0,
    "10 k": 6.0,
}

# events numbered above this limit run against the clock for a set time
TIMED_EVENT_LIMIT = 999
TIMED_EVENT_TIME = "1:30:00.0"

PAYMENT_SPELLINGS = {
    "cash": ["Cash", "cash/comp"],
    "check": ["Check"],
    "credit": ["Authorize", "CC", "cc", "$261 CC, $30 cash"],
    "paypal": ["PayPal", "PayPal pending"],
    "comp": ["Comp"],
}
PAYMENT_OTHER = "other"

CONTACT_SPELLINGS = {
    "No": ["no", "NO", "0"],
    "Yes": ["yes", "YES", "-1"],
}
CONTACT_MISSING = "No Response"

# yearly series ids that stand for the same series
SERIES_SAME_AS = {4: 1, 5: 2, 6: 3}
SCRAMBLE_EVENT_TYPE = "Street Scramble"
SCRAMBLE_SERIES = 4

SERIES_LABELS = {
    0: "No Series",
    1: "Winter Series",
    2: "Half Marathon Series",
    3: "Summer Series",
    4: "Street Scramble",
}

UNKNOWN_ZIP = -1

# -- fixed values: retention -----------------------------------------------

RETURN_WINDOW_DAYS = 183
ONE_OFF = "One Off"
MULTIPLE = "Multiple"

# -- fixed values: models --------------------------------------------------

TEST_SHARE = 0.2
VALIDATION_SHARE = 0.2

# final recommenders: item column -> number of latent factors
RECOMMENDER_RANKS = {
    "series_id": 5,
    "event_type_id": 30,
    "venue_zip": 5,
    "total_fee_avg": 5,
    "miles_avg": 5,
}
RECOMMENDER_ALPHA = 80.0

# recommender grid search
SEARCH_ALPHAS = [10.0, 40.0, 80.0]
SEARCH_RANKS = [5, 10, 30]

# boosted ensemble variants: name -> (learning rate, depth, trees, subsample)
BOOSTING_VARIANTS = {
    "base": (0.1, 3, 100, 1.0),
    "v2": (0.01, 10, 1000, 0.5),
    "v3": (0.1, 5, 500, 0.5),
    "v4": (0.1, 3, 100, 0.5),
    "v5": (0.01, 3, 100, 0.5),
    "v6": (0.01, 5, 100, 0.5),
    "v7": (0.01, 3, 100, 1.0),
    "v8": (0.01, 3, 300, 0.5),
}
BOOSTING_FINAL = "v5"
