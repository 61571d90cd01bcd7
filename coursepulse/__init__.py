"""Learning-progress analytics on Spark: every public function takes DataFrames and returns a DataFrame."""
