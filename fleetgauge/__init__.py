"""Fleet-safety analytics expressed as PySpark DataFrame operators."""
