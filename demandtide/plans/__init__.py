"""Compositions: preparation jobs, masters, supervised tables, forecasts, splits, scenarios, KPIs."""
