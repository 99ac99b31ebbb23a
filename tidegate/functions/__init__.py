"""Column builders: text cleaning, typed conversion, row conditions, log text."""
