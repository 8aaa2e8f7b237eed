"""Reading tables and datasets."""
