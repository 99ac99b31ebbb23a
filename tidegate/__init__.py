"""Control-table-driven loading, checking and reporting on Spark DataFrames."""

from tidegate.model import ControlColumn, LoadSpec, RunContext, TargetType

__all__ = ["ControlColumn", "LoadSpec", "RunContext", "TargetType"]
