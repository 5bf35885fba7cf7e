"""Training-data operators: near-duplicate removal, classifiers, joins, sharding, media, tokenising, packing.

Nothing outside this subpackage imports it.
"""
