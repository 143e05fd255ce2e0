"""recprep: turn shopping and activity logs into recommender training tables, on Spark."""

from recprep.config import BuildConfig, DegradeConfig, RatingConfig
from recprep.session import get_session, tune

__all__ = ["BuildConfig", "DegradeConfig", "RatingConfig", "get_session", "tune"]
