"""Ticket-price analytics as plain Spark DataFrame functions.

Every public function takes and returns DataFrames, so a pipeline is a chain of
``df.transform(...)`` calls whose plan Catalyst optimises as a whole.
"""
