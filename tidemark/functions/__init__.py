"""tidemark: medallion refinement operators on Spark."""
