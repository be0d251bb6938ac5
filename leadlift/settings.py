"""Names and default parameters shared by the operators and flows."""

# Column roles of the customer table.
KEY = "customer_id"
ID_COLUMNS = ["customer_id", "email", "phone"]
LABEL = "applied_cc"
SCORE = "p_apply"
CATEGORICAL = ["region", "channel"]
FEATURES = [
    "age",
    "annual_income",
    "credit_score",
    "utilization_rate",
    "tenure_months",
    "txn_count_3m",
    "avg_txn_amount_3m",
    "late_payments_12m",
    "savings_balance",
    "region",
    "is_premium",
    "has_mortgage",
    "channel",
]

# The scorecard, feature -> (weight, centre).
SCORECARD = {
    "credit_score": (0.025, 650.0),
    "annual_income": (0.000012, 60000.0),
    "txn_count_3m": (0.030, 15.0),
    "tenure_months": (0.002, 24.0),
    "is_premium": (0.55, 0.0),
    "has_mortgage": (0.10, 0.0),
    "utilization_rate": (-2.0, 0.0),
    "late_payments_12m": (-0.45, 0.0),
}
LABEL_NOISE = 1.2

# Default parameters of the flows.
SEED = 42
TEST_SHARE = 0.25
VALID_SHARE = 0.2
TOP_K = 8
TUNE_TRIALS = 10
MIN_LEAD_DECILE = 9
EXPLAIN_TOP_N = 5
REPORT_THRESHOLDS = [0.3, 0.5, 0.7]
F1_GRID_POINTS = 101
BASELINE_LABEL = "baseline_valid"
FINAL_LABEL = "final_test"

# Boosting defaults and the random-search ranges (low inclusive, high exclusive).
GBT_DEFAULTS = {
    "maxIter": 80,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "maxBins": 32,
    "minInstancesPerNode": 1,
    "minInfoGain": 0.0,
    "patience": 40,
}
TUNE_SPACE = {
    "maxIter": (40, 160),
    "maxDepth": (3, 8),
    "stepSize": (0.03, 0.2),
    "subsamplingRate": (0.7, 1.0),
    "maxBins": (16, 64),
    "minInstancesPerNode": (1, 60),
    "minInfoGain": (0.0, 0.01),
    "patience": (20, 60),
}
# Own values for trees over histograms: the same, with a leaf penalty and noise on the gain of splits.
BOOST_DEFAULTS = {**GBT_DEFAULTS, "l2": 3.0, "randomStrength": 1.0}
BOOST_SPACE = {**TUNE_SPACE, "l2": (1.0, 12.0), "randomStrength": (0.0, 2.0)}

# Column order of a metrics report.
METRIC_COLUMNS = [
    "label",
    "n",
    "pos_rate",
    "threshold",
    "auc_roc",
    "auc_pr",
    "log_loss",
    "accuracy",
    "precision",
    "recall",
    "f1",
    "tp",
    "fp",
    "tn",
    "fn",
]
