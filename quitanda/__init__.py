"""Sales warehouse on Spark: cleaning, star-schema loading and marts as DataFrame functions."""
