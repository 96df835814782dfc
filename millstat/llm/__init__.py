"""Operators for preparing training data: near-duplicate removal, sharding,
language ID, decontamination, secret scans, classifiers, packing and token
files. Nothing else in the library imports this subpackage."""
