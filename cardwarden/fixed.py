"""Names, labels, bounds and formats that results must agree on."""

# --- names of the card-transaction model -------------------------------------------------
ID = "TransactionID"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"
TARGET = "isFraud"
MISSING_SUFFIX = "_missing"

# --- decisions ---------------------------------------------------------------------------
THRESHOLD = 0.60
REVIEW = "FRAUD REVIEW"
LEGITIMATE = "LEGITIMATE"
TOWARD_FRAUD = "toward_fraud"
TOWARD_LEGITIMATE = "toward_legitimate"

# --- chronological split -----------------------------------------------------------------
TRAIN_END = 0.70
VALID_END = 0.85

# --- threshold sweep: 0.10 … 0.90 in steps of 0.05 -----------------------------------------
SWEEP_THRESHOLDS = [0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90]
TEST_THRESHOLDS = [0.50, 0.60, 0.70]

# --- stored results ----------------------------------------------------------------------
STORE_KEY_PREFIX = "fraud:risk:"
STORE_TTL_SECONDS = 300

# --- histogram upper bounds ----------------------------------------------------------------
REQUEST_SECONDS_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
RISK_SCORE_BOUNDS = [0.01, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0]
INFERENCE_SECONDS_BOUNDS = [0.001, 0.002, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5]

# --- audits ------------------------------------------------------------------------------
LEAKAGE_NAMES = ["target", "label", "fraud", "is_fraud"]
HIGH_CARDINALITY = 1000
MIN_GROUP_ROWS = 100
DESCRIBE_PROBS = [0.25, 0.50, 0.75]
WIDE_PROBS = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]

# --- feature families, in the order a feature list is built ---------------------------------
FEATURE_FAMILIES = [
    ("transaction", r"TransactionDT|TransactionAmt|ProductCD"),
    ("card", r"card\d+"),
    ("address", r"addr1|addr2|dist1|dist2"),
    ("email", r"P_emaildomain|R_emaildomain"),
    ("c", r"C\d+"),
    ("d", r"D\d+"),
    ("m", r"M\d+"),
    ("v", r"V\d+"),
    ("identity", r"id_\d+"),
    ("device", r"DeviceType|DeviceInfo"),
]
CONTRACT_FEATURES = 432

# --- the fifteen columns of the small linear model -------------------------------------------
BASELINE_FEATURES = [
    "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card2", "card3", "card4", "card5", "card6",
    "addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain",
]

# --- model settings --------------------------------------------------------------------------
SEED = 42
LINEAR_ITERATIONS = 300
# Trees of a boosted fit unless the caller names another number.
TREES = 1000
BOOSTED = {"depth": 6, "rate": 0.05, "row_share": 0.8, "column_share": 0.8, "child_weight": 5.0, "seed": SEED}
REGULARISED = {"depth": 4, "rate": 0.05, "row_share": 0.8, "column_share": 0.7, "child_weight": 10.0,
               "least_gain": 0.1, "l1": 0.1, "l2": 2.0, "seed": SEED}
ATTRIBUTION_SAMPLE = 5000
