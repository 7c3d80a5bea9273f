"""DataFrame-to-DataFrame operators.  None of them collects rows of the data path."""
