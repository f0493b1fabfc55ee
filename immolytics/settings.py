"""Column names and constants shared by the whole package."""

# --- fixed values that must equal the reference's -------------------------
REGRESSION_TARGET = "prix"
CLASSIFICATION_TARGET = "en_dessous_du_marche"
RANDOM_STATE = 42

# Columns kept by the loader, in this order (missing ones are skipped).
LOADED_COLUMNS = [
    "prix", "id_ville", "ville", "type_batiment", "vefa", "n_pieces",
    "surface_habitable", "latitude", "longitude", "mois_transaction",
    "annee_transaction", "prix_m2", "prix_m2_moyen", "nb_transactions_mois",
    "en_dessous_du_marche", "nom_departement", "nom_region",
]

# City-month grouping keys and the city key used by the lag windows.
CITY_MONTH_KEYS = [
    "nom_departement", "ville", "id_ville", "annee_transaction",
    "mois_transaction", "nb_transactions_mois",
]
CITY_KEYS = ["nom_departement", "ville", "id_ville"]
JOIN_KEYS = ["nom_departement", "ville", "id_ville", "annee_transaction", "mois_transaction"]
DEPARTMENT_MONTH_KEYS = ["nom_departement", "annee_transaction", "mois_transaction"]

# Columns dropped after the feature join.
DROPPED_AFTER_JOIN = [
    "nom_departement", "id_ville", "ville", "prix_m2", "prix_m2_moyen",
    "nb_transactions_mois", "n_pieces",
]

# Categorical columns one-hot encoded before training.
COLS_TO_ENCODE = ["type_batiment", "nom_region"]

# Regions accepted by the scoring form (raw spelling; normalised on use).
ALLOWED_REGIONS = [
    "Nouvelle-Aquitaine",
    "Occitanie",
    "Provence-Alpes-Côte d'Azur",
    "Île-de-France",
    "Auvergne-Rhône-Alpes",
]

# Gradient-boosting hyper-parameters of the price model.
GBT_PARAMS = dict(
    stepSize=0.07, maxDepth=5, maxIter=150, minInstancesPerNode=2,
    subsamplingRate=0.9, seed=RANDOM_STATE,
)

DEMAND_QUANTILE = 0.8          # ratio quantile above which a city is "in demand"
TEST_SIZE = 0.2                # train/test split
REFERENCE_FRACTION = 0.8       # data-drift reference sample
N_SPLITS = 5                   # expanding-window folds
DRIFT_THRESHOLD = 0.05         # per-column drift score threshold
DRIFT_SHARE_GATE = 0.2         # pipeline stops above this share of drifted columns
MODEL_DRIFT_THRESHOLD = 0.1    # relative metric change that counts as model drift
STRONG_CORRELATION = 0.7       # |r| above which two features are redundant
# ---------------------------------------------------------------------------

# Row key carried through the pipeline instead of a positional index.
ROW_KEY = "id_transaction"
# The row key after the fan-out of the feature join: row key and monthly volume.
LINE_KEY = "id_ligne"
