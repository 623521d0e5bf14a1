"""tidewell: a change-data-capture lakehouse engine on plain PySpark."""
