"""Choice analytics on Spark: what was chosen in a state, by whom, and how did it turn out."""
