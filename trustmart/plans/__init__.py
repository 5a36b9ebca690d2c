"""End-to-end plans: the lazily built model, the publication run and the query registry."""
