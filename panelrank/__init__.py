"""panelrank: cross-sectional ranking of daily time series as lazy Spark plans."""
