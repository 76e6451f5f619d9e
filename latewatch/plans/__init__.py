from latewatch.plans.registry import QUERIES, SQL
from latewatch.plans import flight_queries, model_queries, io_queries  # noqa: F401  (registers the queries)

__all__ = ["QUERIES", "SQL"]
