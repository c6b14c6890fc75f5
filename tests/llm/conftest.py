"""Small tables with nulls, empty texts, ties and repeats."""
