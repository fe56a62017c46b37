"""Financial planning and analysis on Spark: DataFrame in, DataFrame out."""
