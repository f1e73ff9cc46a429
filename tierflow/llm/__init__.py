"""Operators of a training-data pipeline over documents, pages, chats and vectors.

Every operator takes and returns DataFrames. Rows stay in the tasks that read
them unless an operator says that it shuffles; Python runs over Arrow batches,
cut so that the texts of one step stay within a few MB.
"""
