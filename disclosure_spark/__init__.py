"""Batch analytics over nested price-transparency index files, on Spark."""
