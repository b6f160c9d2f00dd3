"""Column functions: text cleaning, hashes, ids and score flags."""
