"""Credit-portfolio cleansing and risk scoring on Spark DataFrames."""
