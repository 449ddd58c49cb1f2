"""Distributed operators the models are built from."""
