"""turnout: participation analytics expressed as Spark DataFrame and Spark ML jobs."""
