"""Scalar functions with JDK semantics (split, length, hashCode, double text)."""

from tempest.functions.java import java_double_text, java_gt, java_hash, java_length, java_lt, java_split

__all__ = ["java_double_text", "java_gt", "java_hash", "java_length", "java_lt", "java_split"]
