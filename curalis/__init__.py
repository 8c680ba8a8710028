"""Clinical-text curation and de-identification as Spark plans."""
