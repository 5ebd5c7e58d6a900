"""Mapping of the driver's tables onto the domain tables, and a SQL oracle over them."""
