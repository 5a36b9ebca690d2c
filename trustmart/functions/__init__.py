"""Column-level helpers: cleansing, order metrics and KPI expressions."""
