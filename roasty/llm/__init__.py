"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage. One module per
operator; ``queries`` registers them over the tables of a data folder."""
