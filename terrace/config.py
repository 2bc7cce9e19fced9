"""Fixed domain values: column groups, level orders, rules and message sets of
the housing-sales layout."""

from __future__ import annotations


# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the original pipeline's values for results
# to agree.  Stated plainly, in their natural order.
# ---------------------------------------------------------------------------

# Columns whose missing value means "structure absent" -> string "None".
NONE_COLS = [
    "PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "MasVnrType",
    "GarageType", "GarageFinish", "GarageQual", "GarageCond", "BsmtQual",
    "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2",
]

# Columns whose missing value means "structure absent" -> 0.
ZERO_COLS = [
    "MasVnrArea", "GarageArea", "GarageCars", "BsmtFinSF1", "BsmtFinSF2",
    "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath",
]

# Quality rating -> score used by the QualSum feature.
QUAL_MAP = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "None": 0}

# Ordered categories: level order defines the ordinal code (0, 1, 2, ...).
_QUALITY_LEVELS = ["None", "Po", "Fa", "TA", "Gd", "Ex"]
ORDINAL_LEVELS: dict[str, list[str]] = {
    "ExterQual": _QUALITY_LEVELS,
    "ExterCond": _QUALITY_LEVELS,
    "BsmtQual": _QUALITY_LEVELS,
    "BsmtCond": _QUALITY_LEVELS,
    "HeatingQC": _QUALITY_LEVELS,
    "KitchenQual": _QUALITY_LEVELS,
    "FireplaceQu": _QUALITY_LEVELS,
    "GarageQual": _QUALITY_LEVELS,
    "GarageCond": _QUALITY_LEVELS,
    "BsmtExposure": ["None", "No", "Mn", "Av", "Gd"],
    "BsmtFinType1": ["None", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "BsmtFinType2": ["None", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "GarageFinish": ["None", "Unf", "RFn", "Fin"],
    "Functional": ["Sal", "Sev", "Maj2", "Maj1", "Mod", "Min2", "Min1", "Typ"],
    "PavedDrive": ["N", "P", "Y"],
    "LotShape": ["IR3", "IR2", "IR1", "Reg"],
    "LandSlope": ["Sev", "Mod", "Gtl"],
    "Fence": ["None", "MnWw", "GdWo", "MnPrv", "GdPrv"],
}

# Default column lists from the original parameter file.
DROP_COLS = ["Id", "Utilities", "Street", "Condition2", "RoofMatl", "Heating",
             "PoolQC", "MiscFeature"]
DROP_AFTER = ["GarageArea", "GarageYrBlt", "PoolArea", "MiscVal", "LotRatio",
              "IsRemodeled"]

# Name patterns that mark a missing value as a structural absence.
ABSENT_PATTERNS = ["PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu",
                   "Garage", "Bsmt", "MasVnrType"]

# Price bands: half-open [lo, hi), labels in display order.
PRICE_BANDS = [("<$150k", None, 150000.0), ("$150-300k", 150000.0, 300000.0),
               ("$300-450k", 300000.0, 450000.0), (">$450k", 450000.0, None)]

# Codes turned into strings after the age features are computed.
CODE_COLS = ["MSSubClass", "MoSold", "YrSold"]

# Request aliases accepted by the scorer.
REQUEST_ALIASES = {"first_flr_sf": "1stFlrSF", "second_flr_sf": "2ndFlrSF"}

# Record validation: required fields, numeric ranges [lo, hi], closed sets.
REQUIRED_FIELDS = ["OverallQual", "GrLivArea", "Neighborhood"]
NUMERIC_RANGES = {
    "OverallQual": (1, 10), "GrLivArea": (300.0, 6000.0),
    "OverallCond": (1, 10), "YearBuilt": (1870, 2026), "YearRemodAdd": (1870, 2026),
    "TotalBsmtSF": (0.0, 6500.0), "1stFlrSF": (0.0, 5000.0), "2ndFlrSF": (0.0, 2500.0),
    "GarageCars": (0, 5), "FullBath": (0, 4), "HalfBath": (0, 2),
    "BsmtFullBath": (0, 3), "BsmtHalfBath": (0, 2), "BedroomAbvGr": (0, 8),
    "TotRmsAbvGrd": (2, 15), "Fireplaces": (0, 4), "LotArea": (1000.0, 250000.0),
    "LotFrontage": (20.0, 350.0), "YrSold": (2006, 2026), "MoSold": (1, 12),
}
NEIGHBORHOODS = [
    "Blmngtn", "Blueste", "BrDale", "BrkSide", "ClearCr", "CollgCr", "Crawfor",
    "Edwards", "Gilbert", "IDOTRR", "MeadowV", "Mitchel", "NAmes", "NPkVill",
    "NWAmes", "NoRidge", "NridgHt", "OldTown", "SWISU", "Sawyer", "SawyerW",
    "Somerst", "StoneBr", "Timber", "Veenker",
]
ALLOWED_SETS = {
    "MSZoning": ["C (all)", "FV", "RH", "RL", "RM"],
    "SaleCondition": ["Abnorml", "AdjLand", "Alloca", "Family", "Normal", "Partial"],
    "KitchenQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "ExterQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "BsmtQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "CentralAir": ["Y", "N"],
}

# Missing-token set of the CSV reader (pandas defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]

# MAPE denominator floor (float64 machine epsilon).
MAPE_EPS = 2.220446049250313e-16

# FIXED VALUES of the compared, searched and tuned models: rates, depths and
# sampling of the boosting models (15 leaves: depth 4), the search spaces
# (log / uniform / int ranges) with their trials, the published best parameters.
BOOSTING_ROUNDS, FOREST_TREES, CV_REPEATS = 1000, 300, 3
BOOSTING = {
    "xgboost": dict(stepSize=0.03, maxDepth=4, subsamplingRate=0.8, featureSubsetStrategy="0.7", minInstancesPerNode=1),
    "lightgbm": dict(stepSize=0.03, maxDepth=4, subsamplingRate=0.8, featureSubsetStrategy="0.7", minInstancesPerNode=20),
    "catboost": dict(stepSize=0.05, maxDepth=6, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=1)}
PENALTY = ("log", 1e-5, 1e-2)
SEARCH_SPACES = {
    "Lasso": {"alpha": PENALTY},
    "ElasticNet": {"alpha": PENALTY, "l1_ratio": ("uniform", 0.05, 0.95)},
    "XGBoost": {"n_estimators": ("int", 400, 2000), "learning_rate": ("log", 0.01, 0.1), "max_depth": ("int", 2, 6),
                "min_child_weight": ("int", 1, 10), "subsample": ("uniform", 0.5, 1.0), "colsample_bytree": ("uniform", 0.3, 1.0),
                "reg_lambda": ("log", 1e-3, 10.0), "reg_alpha": ("log", 1e-4, 1.0)},
    "CatBoost": {"iterations": ("int", 500, 2000), "learning_rate": ("log", 0.01, 0.1), "depth": ("int", 4, 8),
                 "l2_leaf_reg": ("log", 1.0, 10.0), "random_strength": ("uniform", 0.0, 2.0),
                 "bagging_temperature": ("uniform", 0.0, 1.0)}}
SEARCH_TRIALS = {"Lasso": 60, "ElasticNet": 60, "XGBoost": 40, "CatBoost": 25}
PUBLISHED_BEST = {
    "Lasso": {"alpha": 0.0006119854691593898},
    "ElasticNet": {"alpha": 0.0006358358856676254, "l1_ratio": 0.6872653200164409},
    "XGBoost": {"n_estimators": 1476, "learning_rate": 0.03262249393408143, "max_depth": 3, "min_child_weight": 4,
                "subsample": 0.8535059794504334, "colsample_bytree": 0.32760317883921475},
    "CatBoost": {"iterations": 1882, "learning_rate": 0.01871879330520506, "depth": 4}}
