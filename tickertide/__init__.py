"""A PySpark engine for market bars, social posts, news and their sentiment."""
