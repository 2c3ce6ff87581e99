"""Threadloom operators."""
