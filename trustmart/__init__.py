"""Trusted commerce reporting on Spark: staging, star schema, KPIs and data contracts."""
