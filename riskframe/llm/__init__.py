"""Operators for preparing training text: ten filters, formatters and packers on whole tables."""
