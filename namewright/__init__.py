"""Text normalisation and taxonomy matching as Spark DataFrame operators."""
