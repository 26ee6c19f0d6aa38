"""Readers, writers and the binding of order-management tables to the star schema."""
