"""Market-data analytics as lazy DataFrame-to-DataFrame operators on Spark."""
