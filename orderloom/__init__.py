"""Order operations of a distributor as PySpark DataFrame operators."""
