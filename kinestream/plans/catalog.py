"""All queries outside the training-data operators, by name."""

from kinestream.plans import aligned, captures, contracts, measures, places, poses, recordings, registrations, rigs, rules, sequences, space, timelines  # noqa: F401  (they register their queries)
from kinestream.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
