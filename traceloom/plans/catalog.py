"""Query catalogue: name -> callable, and name -> DuckDB oracle. Importing a plan module registers its queries."""

from traceloom.plans import assembly, curation, evaluation, pairs, registry, replays, routing, runs, streams, support, tracing  # noqa: F401
from traceloom.plans.registered import ORACLES, QUERIES  # noqa: F401
