"""DataFrame operators, all keyed by ``(date, hour)``."""
