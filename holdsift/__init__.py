"""Fund-disclosure ingestion as Spark jobs: DataFrame in, DataFrame out."""
