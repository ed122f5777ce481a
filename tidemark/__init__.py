"""tidemark: batch-sliced transaction analytics on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function. Operators take a table
that carries a ``batch_index`` column (see ``operators.batches``) and compute
their result for all batches in one job; a single micro-batch is just a table
with one ``batch_index`` value, so the streaming path reuses the same code.
"""

from tidemark.columns import Columns, DEFAULT_COLUMNS

__all__ = ["Columns", "DEFAULT_COLUMNS"]
