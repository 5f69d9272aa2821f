"""Road-traffic lakehouse on Spark: streams and batches of speed readings and road
incidents to landing tables, 15-minute rollups and a star schema."""
