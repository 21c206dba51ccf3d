"""Training-data operators. Nothing outside this folder and its tests imports it."""
