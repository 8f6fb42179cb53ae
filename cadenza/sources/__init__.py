"""Readers and writers: landed JSON feeds, CSV hand-over, Parquet lake, warehouse, state."""
