"""A Spark-native engine for planning, generating and analysing labelled text-image datasets."""
