"""Readers: retail CSV extracts, stored warehouse tables, and the order-line tables."""
