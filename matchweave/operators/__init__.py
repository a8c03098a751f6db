"""DataFrame-to-DataFrame operators: search, fusion, inference, conversations."""
