"""Registered queries and their SQL checks."""
from . import alerting, expressions, featuring, loading, modelling, pricing, reporting, state, storing, streamed, timed

MODULES = (state, alerting, pricing, featuring, reporting, loading, expressions, modelling, storing, streamed, timed)
QUERIES = {n: q for m in MODULES for n, q in m.QUERIES.items()}
ORACLES = {n: s for m in MODULES for n, s in m.ORACLES.items()}
