"""Training-data operators (one module each) and the queries that apply them to whole tables."""
