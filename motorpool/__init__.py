"""Vehicle-rental analytics on Spark: staging, history, star schema and marts."""
