"""User-level operators: pure ``DataFrame -> DataFrame`` functions over fleet tables."""
