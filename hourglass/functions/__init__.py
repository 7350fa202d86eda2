"""Column expressions: scalars (X*, J2, J3) and delimited-line helpers."""

from hourglass.functions import lines, scalars  # noqa: F401
