"""Named queries of the corpus operators."""
