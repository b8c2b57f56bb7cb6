"""Price intelligence over shopping catalogues, as Spark DataFrame operators."""
