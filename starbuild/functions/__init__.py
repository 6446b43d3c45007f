"""Column-level building blocks: ``Column -> Column``, no Python workers involved."""
