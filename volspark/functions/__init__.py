"""Scalar building blocks.

Arguments are column names, SQL expression text or plain numbers. Every closed form is written once
and runs three ways (see ``backend``): inline as a Column that composes in any query, staged as a
chain of projections that keeps large formulas small for the optimizer, or on numpy arrays inside
an Arrow task.
"""
