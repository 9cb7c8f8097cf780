"""Text classification on spark.ml: features, training, evaluation."""
