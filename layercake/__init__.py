"""layercake: point-of-sale analytics in layers (raw, silver, gold) on Spark DataFrames."""
