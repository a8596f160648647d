"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from lodeworks.queries import (  # noqa: F401
    aggregates,
    joins,
    lineage,
    modelling,
    ordered,
    quality,
    questions,
    relational,
    scalars,
    sources,
    streams,
)
from lodeworks.queries.registry import ORACLES, QUERIES  # noqa: F401
