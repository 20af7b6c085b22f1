"""folioflow: scholarly document curation and corpus preparation on Spark."""
