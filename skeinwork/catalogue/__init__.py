"""Every query over the driver's tables with its DuckDB equivalent."""

from . import corpus, distillation, graphs, manifests, monitors, scoring, services

_PARTS = (corpus, scoring, distillation, monitors, graphs, manifests, services)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
