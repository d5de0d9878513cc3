"""Distributed operators built from DataFrame primitives."""
