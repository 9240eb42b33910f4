"""Constants that results depend on and that callers may override."""

from __future__ import annotations

# Clinical table. Name, Spark type, whether zero marks a missing value.
CLINICAL_COLUMNS = [
    ("Pregnancies", "int", False),
    ("Glucose", "double", True),
    ("BloodPressure", "double", True),
    ("SkinThickness", "double", True),
    ("Insulin", "double", True),
    ("BMI", "double", True),
    ("DiabetesPedigreeFunction", "double", False),
    ("Age", "double", False),
    ("Outcome", "int", False),
]

# The 41 indicator terms of the headline rule.
INDICATOR_TERMS = [
    "heroic", "genius", "brilliant", "amazing", "stunning", "incredible",
    "unbelievable", "shocking", "obviously", "clearly", "definitely",
    "totally", "absolutely", "literally", "perfect", "greatest", "best",
    "worst", "terrible", "awful", "hilarious", "weird", "bizarre",
    "announces", "reveals", "confirms", "admits", "vows", "pledges",
    "nation", "area", "local", "man", "woman", "report", "sources",
    "experts", "scientists", "study", "poll", "survey",
]

# Threshold grids. The sentiment grid is a float range whose rounding
# matters: its fifth value lies just below zero, so a score of 0.0 exceeds it.
SENTIMENT_THRESHOLDS = [
    -0.2, -0.15000000000000002, -0.10000000000000003, -0.050000000000000044,
    -5.551115123125783e-17, 0.04999999999999993, 0.09999999999999992,
    0.1499999999999999, 0.1999999999999999, 0.2499999999999999,
    0.2999999999999999, 0.3499999999999998, 0.39999999999999986,
    0.4499999999999999,
]
INDICATOR_THRESHOLDS = [1, 2, 3]
COLOUR_THRESHOLDS = [
    0.05, 0.1, 0.15000000000000002, 0.2, 0.25, 0.3, 0.35000000000000003,
]

# Inclusive HSV bands, (low, high) for H in 0..180, S and V in 0..255.
COLOUR_BANDS = {
    "brown": ((5, 30), (60, 255), (40, 255)),
    "green": ((35, 90), (40, 255), (40, 255)),
    "dark": ((0, 180), (0, 255), (0, 60)),
}

# Leaf classes, by their position in code-point order.
LEAF_CLASSES = ["Potato___Early_blight", "Potato___Late_blight", "Potato___healthy"]
EARLY_BLIGHT, LATE_BLIGHT, HEALTHY = 0, 1, 2

# Image side in pixels.
IMAGE_SIDE = 64

# Vocabulary bounds and the number of shown terms.
MIN_DOCUMENTS = 2
MAX_DOCUMENT_SHARE = 0.90
TOP_TERMS = 5

# Tuning grids of the classifiers.
LOGISTIC_GRID = {
    "regParam": [0.01, 0.1, 1.0],
    "elasticNetParam": [0.0, 0.5, 1.0],
    "maxIter": [50, 100],
}
TREE_GRID = {
    "maxDepth": [3, 5, 7, 10],
    "minInstancesPerNode": [1, 5],
    "impurity": ["gini", "entropy"],
}
FOREST_GRID = {
    "numTrees": [50, 100, 200],
    "maxDepth": [5, 10, 15],
    "minInstancesPerNode": [1, 2],
}
BOOSTED_GRID = {
    "maxIter": [10, 20, 50],
    "maxDepth": [2, 3, 5],
    "stepSize": [0.01, 0.05, 0.1],
}
PERCEPTRON_EPOCHS = [50, 100, 200, 500, 1000, 2000]
HIDDEN_LAYERS = [(64,), (128,), (256,), (128, 64), (256, 128)]

# Folds, seed and split shares (percent).
FOLDS = 5
SEED = 42
TRAIN_PERCENT = 80
STRATIFIED_PERCENTS = [("train", 70), ("val", 15), ("test", 15)]

# The forest of the stream.
STREAM_TREES = 100
STREAM_DEPTH = 5
