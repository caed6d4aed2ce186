"""All registered queries and their SQL, by name."""

from . import building, curating, files, lookups, modelling, verifying

MODULES = [lookups, building, verifying, curating, modelling, files]

QUERIES = {name: f for module in MODULES for name, f in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
