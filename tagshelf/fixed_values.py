"""Word lists, labels, bounds, patterns and formats.

Everything in this file is given from outside and must stay exactly as it is for results to match.
"""

# Names of the input's fields, those of flags and those of whole numbers.
FLAGS = ["windows", "mac", "linux"]
COUNTS = [
    "dlc_count", "metacritic_score", "achievements", "recommendations", "positive", "negative",
    "average_playtime_forever", "median_playtime_forever", "peak_ccu",
]

# Tags that mark an entry as software, and tags that prove it is a game.
NON_GAME_TAGS = [
    "Video Production", "Audio Production", "Photo Editing",
    "Animation & Modeling", "Game Development", "Web Publishing",
    "Accounting", "Utilities", "Software", "Software Training", "Tutorial",
]
GAME_INDICATOR_TAGS = [
    "Singleplayer", "Multiplayer", "Co-op", "PvP", "PvE",
    "Action", "RPG", "Adventure", "Strategy", "Puzzle",
    "Shooter", "Platformer", "Horror", "Survival", "Roguelike",
    "Roguelite", "Indie", "Casual", "Sports", "Racing",
    "Fighting", "Simulation", "Open World", "Sandbox",
    "Story Rich", "Atmospheric", "First-Person", "Third-Person",
    "Top-Down", "Side Scroller", "2D", "3D",
]
MIN_NON_GAME_VOTES = 5
MAX_NON_GAME_ROWS = 1000

# Plausible price range in dollars, both ends kept.
PRICE_MIN, PRICE_MAX = 0, 999

# Accepted release date spellings, tried in this order, as (pattern, Spark format).
# (?U) gives \w and \d their Unicode meaning, \A and \z refuse a trailing newline.
DATE_RULES = [
    (r"(?U)\A\w{3} \d+, \d{4}\z", "MMM d, yyyy"),
    (r"(?U)\A\d{4}-\d{2}-\d{2}\z", "yyyy-MM-dd"),
]

# Fixed value: a name holding this word is a test entry.
TEST_NAME = r"(?iU)\btest\b"

# First year of the release trend, sizes of the reports, group thresholds.
RELEASES_SINCE = "2000-01-01"
TOP_PLAYTIME_TAGS = 30
TOP_RELEASE_TAGS = 15
TOP_MODEL_TAGS = 20
TOP_REVIEW_TAGS = 30
MIN_GAMES_PER_TAG = 20
MIN_GAMES_PER_TAG_MODEL = 10
MIN_REVIEWS_PER_GAME = 10
MIN_REVIEWS_PER_TAG = 500
WILSON_Z = 1.645

# Price bracket as (sort_order, exclusive upper bound); then the labels by sort_order.
# 0 is for a missing price, 1 for a price of exactly 0, 8 for everything from the last bound up.
PRICE_BRACKET_BOUNDS = [(2, 5), (3, 10), (4, 20), (5, 30), (6, 40), (7, 60)]
PRICE_BRACKET_LABELS = {
    "view": [
        "Unknown", "Free", "$0.01–$4.99", "$5–$9.99", "$10–$19.99",
        "$20–$29.99", "$30–$39.99", "$40–$59.99", "$60+",
    ],
    "report": [
        "Unknown", "Free", "$0.01 – $4.99", "$5 – $9.99", "$10 – $19.99",
        "$20 – $29.99", "$30 – $39.99", "$40 – $59.99", "$60+",
    ],
}

# Band of an average achievement count; an average of 0 is the first label, then each
# label holds up to its exclusive bound, and the last one holds the rest.
ACHIEVEMENT_BAND_BOUNDS = [15, 50, 100]
ACHIEVEMENT_BAND_LABELS = {
    "view": ["None", "Low (1–14)", "Mid (15–49)", "High (50–99)", "Very High (100+)"],
    "report": ["None", "Low  (1–14)", "Mid  (15–49)", "High (50–99)", "Very High (100+)"],
}
CORRELATION_COLUMN = {"view": "playtime_achievements_corr", "report": "playtime_achievement_corr"}

# Labels of the two price models.
FREE_MODEL, PAID_MODEL = "Free to Play", "Paid"

# Names of the six published views.
VIEW_NAMES = [
    "v_kpi_playtime_by_tag", "v_kpi_releases_by_year_tag", "v_kpi_playtime_by_price",
    "v_kpi_f2p_vs_paid", "v_kpi_f2p_vs_paid_summary", "v_kpi_review_scores_by_tag",
]
