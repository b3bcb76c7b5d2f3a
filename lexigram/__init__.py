"""Corpus statistics on Spark: n-gram models, word similarity and document task reports."""
