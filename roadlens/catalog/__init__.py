"""Query catalogue: every operator of the inventory bound to the test views.
Each entry is a Spark query ``(spark, sf_dir) -> DataFrame`` and, where the
operator is SQL-expressible, the DuckDB oracle text next to it."""

from .base import QUERIES, SQL  # noqa: F401
from . import scalars, groups, spatial, evaluation, quality, sources, learning, streams, builds  # noqa: F401,E402
