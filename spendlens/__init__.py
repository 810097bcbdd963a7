"""Public-spending analytics as PySpark DataFrame operators."""
