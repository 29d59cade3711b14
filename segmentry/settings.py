"""Fixed values of the segmentation job: every number or name a result depends on."""

# --- event schema -----------------------------------------------------------
REQUIRED_COLUMNS = ["event_time", "event_type", "product_id", "category_id", "user_id", "user_session"]
NUMERIC_COLUMNS = {"product_id": "bigint", "category_id": "bigint", "user_id": "bigint", "price": "double"}
STRING_COLUMNS = ["event_type", "category_code", "brand", "user_session"]

# --- right-closed bins: (edges, labels); below or at the first edge is NULL ---
ACTIVITY_BINS = ([0, 5, 20, 100], ["Low", "Medium", "High", "Very High"])
SPENDING_BINS = ([0, 0.01, 100, 500], ["No Purchase", "Low", "Medium", "High"])
SESSION_BINS = ([0, 1, 3], ["Short", "Medium", "Long"])

# --- preprocessing ----------------------------------------------------------
CORRELATION_THRESHOLD = 0.95
VARIANCE_THRESHOLD = 0.01
IQR_MULTIPLIER = 1.5
CAP_PERCENTILES = (5, 95)
PCA_VARIANCE = 0.95

# --- clustering -------------------------------------------------------------
K_RANGE = list(range(2, 11))
N_INIT = 10
MAX_ITER = 300
TOL = 1e-4
SEED = 42
DEFAULT_K = 5
DBSCAN_EPS = [0.5, 1.0]
DBSCAN_MIN_SAMPLES = [3, 5]
N_BOOTSTRAP = 20
BOOTSTRAP_FRACTION = 0.8

# --- report -----------------------------------------------------------------
NORMALISE_EPSILON = 1e-8
SILHOUETTE_GRADES = ([(0.5, "Excellent"), (0.3, "Good")], "Fair")  # above the limit
DB_GRADES = ([(1.0, "separate"), (2.0, "touching")], "mixed")  # below the limit
