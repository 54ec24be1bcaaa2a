"""attain - quota attainment and incentive pay analytics on PySpark DataFrames."""
