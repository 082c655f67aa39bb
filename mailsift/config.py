"""Settings shared by every job. Sizes are parameters, never literals in the code."""

from __future__ import annotations

from dataclasses import dataclass, field

# Published settings of the workload.
SEED = 42
CLASS_SIZES = {0: 4000, 1: 1000}
SPLIT_SIZES = {"train": 3500, "valid": 750, "test": 750}
MIN_BODY_CHARS = 10
THRESHOLD_START, THRESHOLD_END, THRESHOLD_STEP = 0.05, 0.95, 0.01
PRECISION_FLOOR = 0.95
DEPLOYED_THRESHOLD = 0.84
RISK_SAFE_BELOW, RISK_SUSPICIOUS_BELOW = 0.30, 0.70
WORD_NGRAMS = (1, 2)
CHAR_NGRAMS = (3, 5)
MIN_DF = 2
MAX_FEATURES = 30_000
SVD_MAX_FEATURES = 50_000
SVD_COMPONENTS = 200
NB_ALPHA = 0.5
MAX_TEMP_SHARE = 0.4
HISTORY_ROWS = 500
TOP_ERRORS = 50
TOP_COEFFICIENTS = 30
PREVIEW_CHARS = 120
ID_PREFIX_CHARS = 200
PROB_CLIP = 1e-6


@dataclass(frozen=True)
class Settings:
    """One run's parameters; the defaults are the published ones."""

    seed: int = SEED
    class_sizes: dict = field(default_factory=lambda: dict(CLASS_SIZES))
    split_sizes: dict = field(default_factory=lambda: dict(SPLIT_SIZES))
    min_body_chars: int = MIN_BODY_CHARS
    precision_floor: float = PRECISION_FLOOR
    deployed_threshold: float = DEPLOYED_THRESHOLD
    max_features: int = MAX_FEATURES
    min_df: int = MIN_DF
