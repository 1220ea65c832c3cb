"""tidemark: network-flow analytics as PySpark DataFrame transformations."""
