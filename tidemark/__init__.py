"""tidemark: revision-driven ETL feeds as plain PySpark DataFrame operators."""
