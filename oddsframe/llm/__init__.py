"""Training-data operators for text corpora; nothing else in the package imports this folder."""
