"""Operators that prepare documents, pages and conversations for the training of language models."""
