"""Operators that turn raw documents, pages and vectors into training data."""
