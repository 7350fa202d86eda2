"""Training-data operators: dedup, joins, classifiers, sharding, mixing, tokenising.

One module per operator; ``queries`` registers them. Nothing outside this
subpackage (and the pipeline file at the repository top) imports it.
"""
