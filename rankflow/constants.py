"""Fixed values of the ranking domain.

FIXED VALUES: the numbers, names and lists below must equal the behaviour
being reproduced (metric weights, score weights, limits, topic order,
experiment layout). They are kept together here, in natural order, and every
operator takes them as overridable parameters.
"""

from __future__ import annotations

# --- fixed values: topics / categories, in their canonical display order ----
TOPICS = ("ai", "backend", "system-design", "devops", "interview-prep")
CATEGORIES = TOPICS
CONTENT_STATUSES = ("draft", "published")
CANDIDATE_SOURCES = ("recent", "trending", "topic_affinity")

# --- fixed values: interaction event types and the metric each one counts ---
EVENT_TYPES = (
    "impression",
    "click",
    "like",
    "save",
    "skip",
    "watch_start",
    "watch_complete",
)
METRIC_FOR_EVENT = {
    "impression": "impressions",
    "click": "clicks",
    "like": "likes",
    "save": "saves",
    "skip": "skip_count",
    "watch_start": "watch_starts",
    "watch_complete": "watch_completes",
}
METRICS = tuple(METRIC_FOR_EVENT.values())

# --- fixed values: trending and topic-affinity weights per metric ----------
TRENDING_WEIGHTS = {
    "impressions": 0.1,
    "clicks": 1.0,
    "likes": 3.0,
    "saves": 4.0,
    "skip_count": -2.5,
    "watch_starts": 0.75,
    "watch_completes": 3.5,
}
AFFINITY_WEIGHTS = {
    "impressions": 0.2,
    "clicks": 1.5,
    "likes": 4.0,
    "saves": 5.0,
    "skip_count": -3.0,
    "watch_starts": 1.0,
    "watch_completes": 4.5,
}
# quality bonus multipliers inside the trending score: ctr, like, save, completion
TRENDING_BONUS = {"ctr": 10.0, "like": 6.0, "save": 8.0, "completion": 12.0}
AFFINITY_COMPLETION_BONUS = 5.0

# --- fixed values: feature window -----------------------------------------
FEATURE_WINDOW_HOURS = 24
FEATURE_WINDOW_MIN_HOURS = 1
FEATURE_WINDOW_MAX_HOURS = 720

# --- fixed values: ranking strategies --------------------------------------
RULES_V1 = "rules_v1"
RULES_V2 = "rules_v2_with_trending_boost"
STRATEGY_ALIASES = {"rules_based.v1": RULES_V1}
# name, affinity, recency, engagement, trending weight, boost threshold,
# boost multiplier, max adjustment
STRATEGIES = (
    (RULES_V1, 0.35, 0.20, 0.25, 0.20, 1.0, 0.0, 0.0),
    (RULES_V2, 0.32, 0.18, 0.22, 0.28, 0.45, 0.15, 0.08),
)
ENGAGEMENT_WEIGHTS = {
    "ctr": 0.35,
    "like_rate": 0.2,
    "save_rate": 0.2,
    "completion_rate": 0.2,
    "skip_rate": -0.15,
}
RECENCY_HALF_LIFE_HOURS = 48.0
TRENDING_SATURATION = 25.0
DIVERSITY_TOPIC_PENALTY = 0.12
DIVERSITY_CATEGORY_PENALTY = 0.05
MAX_DIVERSITY_PENALTY = 0.35

# --- fixed values: candidate generation and paging -------------------------
RECENT_LIMIT = 40
TRENDING_SEED_LIMIT = 100
TRENDING_SOURCE_LIMIT = 20
TOPIC_CANDIDATE_LIMIT = 20
MAX_TOPIC_SOURCES = 3
RUNTIME_AFFINITY_WEIGHT = 0.7
PROFILE_AFFINITY_WEIGHT = 0.3
PAGE_DEFAULT_LIMIT = 20
PAGE_MAX_LIMIT = 100
FEED_CACHE_TTL_SECONDS = 60

# --- fixed values: experiment ----------------------------------------------
EXPERIMENT_KEY = "home_feed_ranking.v1"
BUCKET_SPACE = 10000
# variant key, strategy, allocation basis points (in allocation order)
EXPERIMENT_VARIANTS = (
    ("control", RULES_V1, 5000),
    ("trending_boost", RULES_V2, 5000),
)
ANALYTICS_LOOKBACK_HOURS = 168
OUTCOME_EVENT_TYPES = ("click", "save", "watch_complete")
EXPOSURE_EVENT_TYPES = ("impression", "watch_start")

# --- fixed values: validation ----------------------------------------------
INTERACTION_SCHEMA_NAME = "interaction_event.v1"
DEAD_LETTER_SCHEMA_NAME = "dead_letter_event.v1"
CONTENT_FEATURES_SCHEMA_NAME = "content_features.v1"
USER_AFFINITY_SCHEMA_NAME = "user_topic_affinity.v1"
RANKING_DECISION_SCHEMA_NAME = "ranking_decision.v1"
MAX_WATCH_SECONDS = 86400
MAX_SESSION_CHARS = 255
MAX_TOPIC_CHARS = 100
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
USERNAME_PATTERN = r"^[a-zA-Z0-9][a-zA-Z0-9_-]{2,254}$"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# --- fixed values: tag derivation -------------------------------------------
CATEGORY_DEFAULT_TAGS = {
    "ai": ["ai", "llm"],
    "backend": ["backend", "api-design"],
    "system-design": ["system-design", "distributed-systems"],
    "devops": ["devops", "kubernetes"],
    "interview-prep": ["interview-prep", "system-design"],
}
# title keyword -> tag, in matching order
KEYWORD_TAGS = (
    ("database", "databases"),
    ("databases", "databases"),
    ("sql", "databases"),
    ("api", "api-design"),
    ("graphql", "api-design"),
    ("distributed", "distributed-systems"),
    ("scalability", "distributed-systems"),
    ("kubernetes", "kubernetes"),
    ("docker", "kubernetes"),
    ("llm", "llm"),
    ("transformer", "llm"),
)

# --- fixed values: operations ----------------------------------------------
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
SNAPSHOT_FLUSH_ROWS = 25
SNAPSHOT_FLUSH_SECONDS = 15
PROCESSING_ATTEMPTS = 3
