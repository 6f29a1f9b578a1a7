"""Named queries over the driver's tables, each with an independent SQL oracle if it has one."""

from faultline.catalog import errors, models, profiling, scoring, splitting

PARTS = (profiling, splitting, scoring, errors, models)


def queries():
    return {name: run for part in PARTS for name, run in part.QUERIES.items()}


def oracle_sql():
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
