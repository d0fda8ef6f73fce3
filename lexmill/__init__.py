"""lexmill: curation and analysis of large text corpora on Spark."""
