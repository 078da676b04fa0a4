"""Operators on texts and on very large numeric columns for training-data pipelines. Nothing outside imports this."""
