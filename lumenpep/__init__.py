"""A Spark-native engine for peptide analytics: candidate peptides from proteins, features, ranking and evaluation."""
