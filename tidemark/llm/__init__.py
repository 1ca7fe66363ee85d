"""Operators for training-data pipelines.  Nothing else in the library imports
this subpackage; ``tidemark.llm.registry`` holds its queries and their SQL."""
