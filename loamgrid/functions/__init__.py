"""Column expressions shared by the operators."""
from .expressions import *  # noqa: F401,F403
