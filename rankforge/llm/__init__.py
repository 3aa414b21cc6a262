"""Operators of a training-data pipeline. Nothing else in the library imports this package;
each operator has its own module and ``registry`` holds the registered queries."""
