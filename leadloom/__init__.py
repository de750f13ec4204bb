"""Lead, appointment and commission analytics on Spark DataFrames."""
