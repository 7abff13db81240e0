"""Job settings: defaults, overridden by a JSON file."""

from __future__ import annotations

import copy
import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tablewright.fixed_values import JOB_DEFAULTS

log = logging.getLogger(__name__)

# settings of this engine beside the common ones
EXTRA_DEFAULTS = {
    "preprocessing": {"impute_target": True, "scale_at": "clean", "sequential_outliers": True},
    "feature_engineering": {"exclude_leaky": True, "pca_components": 0.95,
                            "importance_method": "f_regression"},
    "evaluation": {"learning_curve": True},
    "model_training": {"models": None, "cv_folds": 5, "tuning_method": "grid_search",
                       "seed": 42},
}


def merge(base: dict, update: dict) -> dict:
    """``base`` with ``update`` laid over it, section by section."""
    out = dict(base)
    for key, value in update.items():
        known = out.get(key)
        out[key] = merge(known, value) if isinstance(known, dict) and isinstance(value, dict) \
            else value
    return out


def load_settings(spark: SparkSession | None = None, path: str | None = None,
                  overrides: dict | None = None) -> dict:
    """Defaults, then the settings file, then ``overrides``. An unreadable file only warns."""
    settings = merge(copy.deepcopy(JOB_DEFAULTS), EXTRA_DEFAULTS)
    if path and spark is not None:
        try:
            text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
            settings = merge(settings, json.loads(text))
        except (AnalysisException, ValueError) as error:
            log.warning("settings file %s not used: %s", path, error)
    return merge(settings, overrides or {})
