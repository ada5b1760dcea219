"""Population weighting, expansion and validation as Spark DataFrame programs."""
