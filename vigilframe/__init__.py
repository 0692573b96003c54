"""Spark jobs that keep a jurisdiction risk register up to date from published lists."""

from vigilframe.schema import BOUND, FLAGS, REGISTER, RegisterLayout

__all__ = ["BOUND", "FLAGS", "REGISTER", "RegisterLayout"]
