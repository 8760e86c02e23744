"""Where data goes: layered Parquet, the versioned warehouse, CSV reports."""
