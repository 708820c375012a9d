"""geotally: analyses of geotagged short messages as Spark DataFrame plans."""

from . import schema
from .operators import bayes, stats, words
from .operators.bayes import PlaceModel, fit_place_model, predict_place, score_places
from .operators.stats import (centroid_by, count_by, filtered_count_by, local_hours, peak_local_hour, profile,
                              profile_report)
from .operators.words import top_groups, top_words_in_top_groups, wide_lines, word_counts, word_tokens

__all__ = [
    "PlaceModel", "bayes", "centroid_by", "count_by", "filtered_count_by", "fit_place_model", "local_hours",
    "peak_local_hour", "predict_place", "profile", "profile_report", "schema", "score_places", "stats",
    "top_groups", "top_words_in_top_groups", "wide_lines", "word_counts", "word_tokens", "words",
]
