"""Regular-grid time-series and map-inference analytics on PySpark."""
