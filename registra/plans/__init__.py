"""Named queries over the tables of a data folder, and the same in SQL."""

from registra.plans import reference, reference_sql, register, register_sql

CATALOGUE = {**reference.QUERIES, **register.QUERIES}
ORACLES = {**reference_sql.SQL, **register_sql.SQL}
