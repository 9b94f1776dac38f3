"""Profile tables on Spark: ingest, check, impute, encode, profile, train and score."""
