"""tallyforge: medallion-style feature pipelines and their building blocks on Spark DataFrames."""
