"""Table operators for Spark: keyed data flow, text classification, population
search, coordinate-format tensors, log frequencies and page extraction."""
