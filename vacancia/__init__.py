"""Job-postings analytics as composable PySpark DataFrame operators."""
