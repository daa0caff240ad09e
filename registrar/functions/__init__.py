"""Shared column expressions and order-dependent helpers."""
