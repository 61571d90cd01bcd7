"""Column functions: text cleaning, durations, links, page fields and date helpers."""
