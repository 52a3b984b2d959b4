"""Column expressions: cleaning, loan arithmetic, encodings and ratio features."""
