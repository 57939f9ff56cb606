"""Results depend on them letter for letter."""

# --- fixed values: text cleaning -------------------------------------------
# Literal replacements, applied in this order.
CONTRACTIONS = {
    "can't": "can not",
    "won't": "will not",
    "n't": " not",
    "'re": " are",
    "'s": " is",
    "'d": " would",
    "'ll": " will",
    "'t": " not",
    "'ve": " have",
    "'m": " am",
}

# --- fixed values: label words ---------------------------------------------
LONG_LABELS = {"positive": 1, "negative": 0}
SHORT_LABELS = {"pos": 1, "neg": 0}

# --- fixed values: words that mark the protected slice ---------------------
PROTECTED_WORDS = ("he", "she", "man", "woman", "girl", "boy", "male", "female")

# --- fixed values: perturbation names, in report order ---------------------
PERTURBATIONS = ("lower", "upper", "no_punc", "extra_ws", "typo_swap", "typo_keyboard")

# --- fixed values: neighbouring keys on a QWERTY keyboard ------------------
KEYBOARD_NEIGHBOURS = {
    "a": "qws", "b": "vghn", "c": "xdfv", "d": "erfcxs", "e": "rdsw",
    "f": "rtdgcv", "g": "tyfhvb", "h": "yugjnb", "i": "uojk", "j": "uikhmn",
    "k": "ijolm", "l": "kop", "m": "njk", "n": "bhjm", "o": "ipl",
    "p": "ol", "q": "wa", "r": "etdf", "s": "wedxz", "t": "ryfg",
    "u": "yihj", "v": "cfgb", "w": "qeas", "x": "zsdc", "y": "tugh",
    "z": "asx",
}

# --- fixed values: limits of the repair rules ------------------------------
MAJORITY_LIMIT = 0.6
TOXICITY_LIMIT = 0.7
TPR_GAP_LIMIT = 0.1
DEDUPE_THRESHOLD = 0.92

# --- fixed values: wording of the repair plan (title, reason, action) ------
# %s / %d / %.2f places are filled by format_string.
SUGGESTIONS = {
    "dedup": (
        "Remove near-duplicates",
        "Found %d pairs above similarity threshold.",
        "drop one item from each high-similarity pair to reduce leakage and redundancy.",
    ),
    "rebalance": (
        "Rebalance classes",
        "Class distribution is skewed (majority=%s ~%.2f, minority=%s ~%.2f).",
        "either downsample majority or upsample minority for training.",
    ),
    "augment": (
        "Augment for robustness",
        "Highest flip rate under '%s' perturbation.",
        "augment training data with '%s' style noise; "
        "consider char-level normalization & token cleanup.",
    ),
    "toxicity": (
        "Moderate toxic content",
        "High 95th percentile toxicity score (~%.2f).",
        "filter or downweight highly toxic samples; include counterfactual data if relevant.",
    ),
    "fairness": (
        "Fairness reweighting",
        "Equalized odds TPR difference ~%.2f.",
        "reweight sensitive slices or perform post-hoc thresholding by group.",
    ),
}

# --- fixed values: classifier and sampling defaults ------------------------
MAX_FEATURES = 30_000
MAX_ITERATIONS = 300
TOLERANCE = 1e-4
TRAIN_FRACTION = 0.8
SEED = 42
SIMILARITY_THRESHOLD = 0.9
PREFIX_CHARS = 200
TOP_TOKENS = 10
DRIFT_ALPHA = 0.05
