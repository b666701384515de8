"""Map-element analytics on PySpark: layers, spatial joins, tiles and metrics."""
