"""Column functions: null rules, keyed draws, text, recodes, dates and quantiles."""
