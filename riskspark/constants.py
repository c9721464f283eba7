"""The numbers and words that define the results."""

# --- fixed values: base score -------------------------------------------------
SEVERITY_WEIGHT = 0.4
PROBABILITY_WEIGHT = 0.4
EXPLOITED_WEIGHT = 0.2
RECENCY_WEIGHT = 0.0
EXPLOITED_FLOOR = 0.9
RECENCY_WINDOW_DAYS = 1095.0

# --- fixed values: group-adjusted score ---------------------------------------
GROUP_DENSITY_ALPHA = 0.5
GROUP_PROBABILITY_BETA = 0.1
FINAL_SCORE_MAX = 1.5

# --- fixed values: levels, highest first --------------------------------------
LEVELS = (("Critical", 0.8), ("High", 0.6), ("Medium", 0.4))
LOWEST_LEVEL = "Low"

# --- fixed values: severity classes, in display order ---------------------------
SEVERITY_CLASSES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "NONE")

# --- fixed values: capacity planning --------------------------------------------
DAILY_CAPACITY = 50
HORIZON_DAYS = 30
ARRIVALS_PER_DAY = 150
STRATEGIES = ("top_priority", "high_epss", "cluster_based", "kev_first", "hybrid")
NO_CLUSTER = -1

# --- fixed values: catalogue window ---------------------------------------------
FIRST_YEAR = 2015

# --- fixed values: grouped actions ----------------------------------------------
UNKNOWN_GROUP = "unknown"
ACTION_TOP_IDS = 5

# --- fixed values: text features and clustering ---------------------------------
CLUSTER_COUNTS = (4, 6, 8, 10, 12)
VOCABULARY_SIZE = 500
MIN_DOCUMENTS = 20
CATEGORY_VOCABULARY_SIZE = 30
CATEGORY_MIN_DOCUMENTS = 5
PCA_COMPONENTS = 100
KMEANS_SEED = 42
KMEANS_ITERATIONS = 20
MIN_TOKEN_LENGTH = 3
TOP_KEYWORDS = 10
TOP_VALUES = 5

# --- fixed values: words too common in the domain to describe a cluster ---------
DOMAIN_STOP_WORDS = (
    "vulnerability", "vulnerabilities", "affected", "affects", "issue", "issues", "allows",
    "attacker", "attack", "remote", "local", "authenticated", "unauthenticated", "successful",
    "exploitation", "exploit", "exploited", "crafted", "malicious", "user", "users", "version",
    "versions", "prior", "before", "following", "resolved", "kernel", "linux", "trace", "call",
    "task", "error", "warning", "function", "file", "system", "data", "may", "could", "can",
    "using", "used", "product", "products", "component",
)
