"""Composed jobs: index bundles, build the dataset, fill the text index, export captions."""
