"""Registered queries over the given tables, each with the SQL it must agree with where SQL can say it."""

from queries import attribution, boosting, cleaning, features, intervals, metrics, models, parsing, preparation, profiles, sinks

GROUPS = (intervals, cleaning, features, parsing, profiles, preparation, metrics, attribution, models, boosting, sinks)


def all_queries() -> dict:
    return {name: run for group in GROUPS for name, run in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
