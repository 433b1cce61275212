"""The five analyses end to end: incidents in, named results and files out."""
