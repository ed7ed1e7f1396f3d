"""Column-level functions (native Spark expressions unless stated otherwise)."""
