"""hearthwatt: home-energy and weather time series on Spark DataFrames."""
