"""DataFrame-to-DataFrame operators: predicates, normalisation, merge, layout."""
