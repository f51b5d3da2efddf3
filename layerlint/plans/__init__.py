"""Named queries over the given tables."""

from layerlint.plans import attribute_queries, job_queries, storage_queries, validation_queries  # noqa: F401
from layerlint.plans.query import QUERIES  # noqa: F401
