"""edgeframe: binary-contract market analytics as PySpark DataFrame operators."""
