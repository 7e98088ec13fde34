"""Operators of a training-data pipeline: filters, detectors, models, joins and mixing over document tables.

Nothing else in the library imports this subpackage.
"""
