"""Column expressions: text cleaning, labels and calendar helpers."""
