"""Champion/challenger evaluation of binary classifiers as Spark DataFrame plans."""
