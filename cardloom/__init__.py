"""Knowledge-card pipelines and training-data operators on Spark."""
