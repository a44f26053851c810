"""Table sources: Parquet tables, derived study entities, codelist CSVs."""
