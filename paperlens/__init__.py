"""Paper analytics on Spark: curation, enrichment, features, scoring, drift."""
