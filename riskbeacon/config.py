"""Fixed values of the task definition.

These constants must equal the published task definition for results to be
comparable; they are stated plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values: crime groups, in their published order -------------------
CRIME_GROUPS = [
    "theft_larceny",
    "assault_battery",
    "burglary",
    "robbery",
    "motor_vehicle_theft",
    "drug_narcotics",
]

# --- fixed values: the 27 numeric model features, in contract order ---------
FEATURE_NUMERIC = [
    "lag_0",
    "lag_1",
    "lag_2",
    "lag_4",
    "rolling_mean_4",
    "rolling_sum_4",
    "ewma_4",
    "neighbor_lag_0",
    "neighbor_lag_1",
    "neighbor_roll_mean_4",
    "neighbor_ewma_4",
    "self_neighbor_ratio_lag0",
    "lag1_share_theft_larceny",
    "lag1_share_assault_battery",
    "lag1_share_burglary",
    "lag1_share_robbery",
    "lag1_share_motor_vehicle_theft",
    "lag1_share_drug_narcotics",
    "month",
    "weekofyear",
    "quarter",
    "sin_weekofyear",
    "cos_weekofyear",
    "region_train_mean",
    "region_train_std",
    "region_train_count",
    "region_seen_in_train",
]

# --- fixed values: defaults of the task definition --------------------------
THRESHOLD_QUANTILE = 0.75
ANCHOR_DATE = "2015-01-01"
TIME_WINDOWS = (7, 3)
EVAL_SEEDS = (0, 1, 2)
SEQUENCE_LENGTH = 8
EWMA_SPAN = 4
ROLL_WINDOW = 4
TOPK_CANDIDATES = (5, 10, 20, 50, 100)
N_REGION_BUCKETS = 4
KNN_K = 3
DEFAULT_STATE = "IL"
DEFAULT_COUNTY = "COOK"

# Dataset (domain) tags of the prediction table, in display order.
DATASET_TRAIN = "in_train"
DATASET_IN = "in_domain"
DATASET_OUT = "out_domain"
DOMAIN_ORDER = [DATASET_IN, DATASET_OUT]

# Stand-in scorers (deterministic "models" so multi-model slices are testable).
MODEL_PERSISTENCE = "baseline_persistence"
MODEL_ROLLING = "rolling_mean"
MODEL_EWMA = "ewma"
MODEL_ORDER = [MODEL_PERSISTENCE, MODEL_ROLLING, MODEL_EWMA]
