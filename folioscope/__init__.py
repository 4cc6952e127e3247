"""A Spark engine for corpora of documents, records about them, and reports."""
