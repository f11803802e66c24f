"""Training-data operators. Nothing outside this subpackage (but corpus_pipeline.py) imports it."""
