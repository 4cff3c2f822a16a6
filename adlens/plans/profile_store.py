"""P3 / S10 kept up to date: profiles as mergeable day parts (:mod:`adlens.sources.day_store`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.sources.day_store import DayStore

WEIGHTS = "user_key string, kind string, tag string, weight bigint"
KEYS = ["user_key", "kind", "tag"]


class ProfileStore(DayStore):
    schema, keys, values, bucket_key, alive = WEIGHTS, KEYS, ["weight"], "user_key", "weight"

    def weights(self, buckets=None) -> DataFrame:
        """``user_key, kind, tag, weight`` over all days."""
        return self.sums(buckets)

    def user(self, user_key: str) -> DataFrame:
        """One user's weights: a single bucket is read."""
        return self.weights([self.bucket_of(F.lit(user_key))]).filter(F.col("user_key") == user_key)
