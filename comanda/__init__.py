"""Restaurant ordering, reservation and delivery analytics on Spark DataFrames."""
