"""Contract values shared by the batch plans, the streams and the tests."""

from __future__ import annotations

import os

MICROS = 1_000_000

# --- fixed values: feature contract -----------------------------------------
WINDOW_SECONDS = 600
RECENCY_LAMBDA = 0.001
AFFINITY_LAMBDA = 0.0005
ONLINE_TTL_SECONDS = 3600
LOG_FLUSH_SECONDS = 60
LOG_FLUSH_ROWS = 500

WATCH_TOPIC = "user.watch.events"
SESSION_TOPIC = "user.session.events"

BASE_FEATURES = [
    "watch_count_10min",
    "category_affinity_score",
    "avg_watch_duration",
    "recency_score",
]
TIME_OF_DAY = ["morning", "afternoon", "evening", "night"]
LABEL = "engaged"
ENGAGED_THRESHOLD = 70.0
CONTRACT_VERSION = "1.0"

TRAINING_RANGE_DAYS = 30
VALIDATION_DAYS = 7
PRECISION_K = 10
BOOST_ROUNDS = 200
LEARNING_RATE = 0.05
MODEL_NAME = "personalization-click-model"
MODEL_ALIASES = ["production", "staging"]

AUDIT_RETENTION_MONTHS = 3
AUDIT_LOOKAHEAD_MONTHS = 2
FRESHNESS_LIMIT_SECONDS = 5.0
TOP_N_DEFAULT = 10
TOP_N_MAX = 100

# --- fixed values: names of the logged training parameters ------------------
LOGGED_PARAMETERS = {
    "model": "model_type",
    "range_days": "training_date_range_days",
    "validation_days": "validation_split_days",
    "threshold": "engaged_threshold",
    "train_rows": "train_rows",
    "validation_rows": "val_rows",
    "positive_rate": "positive_rate_train",
}
LOGGED_MODEL_PREFIX = "model_param_"

# --- fixed values: default catalog, in list order ---------------------------
CATALOG = [
    ("c001", "action", "Shadow Strike"),
    ("c002", "action", "Iron Edge"),
    ("c003", "action", "Blitz Protocol"),
    ("c004", "drama", "The Long Winter"),
    ("c005", "drama", "Borrowed Time"),
    ("c006", "drama", "Still Waters"),
    ("c007", "comedy", "Wrong Floor"),
    ("c008", "comedy", "Plus One"),
    ("c009", "comedy", "Family Chaos"),
    ("c010", "sci-fi", "Event Horizon 2"),
    ("c011", "sci-fi", "Deep Signal"),
    ("c012", "sci-fi", "Nova Station"),
    ("c013", "thriller", "Dark Current"),
    ("c014", "thriller", "Last Witness"),
    ("c015", "thriller", "Cold Room"),
    ("c016", "romance", "Late Arrival"),
    ("c017", "romance", "Second Chance"),
    ("c018", "horror", "The Empty House"),
    ("c019", "horror", "Below Zero"),
    ("c020", "documentary", "The Final Reef"),
]

# --- fixed values: fallback feed, in display order --------------------------
TRENDING = ["c001", "c004", "c007", "c010", "c013", "c016", "c018", "c020"]

# --- fixed values: load-suite thresholds (p95 milliseconds, error percent) --
SLO_SUITES = {
    "baseline": (500.0, 5.0),
    "prod_baseline": (50.0, 1.0),
    "soak": (100.0, 1.0),
    "stress": (200.0, 5.0),
    "spike": (500.0, 10.0),
}

# --- scale parameters (ours) -------------------------------------------------
# A user with more rows than this is computed on the split path, so that no
# task ever sorts one user's whole history.
HOT_USER_ROWS = 2_000_000
# More hot users than this and every row takes the split path instead of
# listing the users in the plan.
MAX_LISTED_HOT_USERS = 5_000
# A hot user's slice of time with more rows than this is cut again, by instant
# and by runs of the sequence (bulk loads share one instant).
BUSY_SLICE_ROWS = 20_000_000
# A hot user's arrivals are cut into pieces of about so many rows, or of BUSY_SLICE_ROWS if
# that is less; of more where there would be more cuts than these, in all or of one user.
PIECE_ROWS = 125_000
MAX_CUTS = 16_384
MAX_USER_CUTS = 1_024
# Up to this many genres get a column each inside the window; beyond it the
# long form is used.
MAX_GENRE_COLUMNS = 64
# Most genres that a model's vocabulary holds.
MAX_VOCABULARY = 50_000
# More of them than this are one sparse vector instead of a column each.
MAX_GENRE_FEATURES = 256
# The online view gets a micro-batch as often as this, and its directories are
# folded together after so many.
ONLINE_TRIGGER_SECONDS = 1
COMPACT_EVERY_BATCHES = 60

def pseudonym_secret() -> str:
    """HMAC secret: from the environment in deployments, a test value otherwise."""
    return os.environ.get("PULSEFEED_PSEUDONYM_SECRET", "pulsefeed-test-secret")

# A first start on a long backlog is cut into micro-batches of at most so many files.
MAX_FILES_PER_BATCH = 256
