"""DataFrame in, DataFrame out: the building blocks of the plans."""
