"""Models, and the named queries over the analytics tables."""

from quarrymill.plans import (  # noqa: F401
    check_queries,
    load_queries,
    model_queries,
    source_queries,
    vocabulary_queries,
)
from quarrymill.plans.registry import CHECK_SQL, QUERIES  # noqa: F401
