"""Training-data operators: ten Spark jobs over whole document and vector tables."""
