"""The analyses: shop SQL pack, sales EDA, warehouse ETL, measures and KPIs, report datasets."""
