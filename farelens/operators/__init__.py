"""Operators: row rules, cleaning and enrichment, KPIs, inspection and analytics."""
