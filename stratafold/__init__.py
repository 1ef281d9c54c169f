"""stratafold: a Spark-first engine that turns page text and page tables of technical documents into typed tables."""
