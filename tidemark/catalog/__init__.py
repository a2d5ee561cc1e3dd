"""The registered queries: the given tables as raw sources, and every operator run on them."""
