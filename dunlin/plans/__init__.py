"""Queries over the driver tables, one module per operator family."""

from dunlin.plans import (  # noqa: F401
    clusters,
    features,
    learning,
    nearest,
    relational,
    scalars,
    scoring,
    tables,
)
from dunlin.plans.registry import QUERIES, SQL  # noqa: F401
