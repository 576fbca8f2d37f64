"""Fact readers, table writers and staging of intermediate tables."""
