from . import aggregates, crosstab, latest, lookups, sampling, sets

__all__ = ["aggregates", "crosstab", "latest", "lookups", "sampling", "sets"]
