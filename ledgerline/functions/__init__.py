"""Column expressions: text, numbers, dates, names, legal descriptions and similarity. All are native, none is a UDF."""
