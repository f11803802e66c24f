"""Column functions: parsing of landed values and model-level scalars."""
