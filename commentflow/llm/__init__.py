"""Operators for training-data pipelines over ``documents(doc_id, text, ...)``; nothing else in the library imports them."""
