"""farelake: a transit lakehouse and feature store written as Spark DataFrame functions."""
