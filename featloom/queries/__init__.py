"""Registered queries: each operator bound to the driver tables, with its SQL check where SQL can express it."""

from featloom.queries.registry import REGISTRY, Query  # noqa: F401
from featloom.queries import cleaning, credits, features, models, profiling, sources, text  # noqa: F401, E402
