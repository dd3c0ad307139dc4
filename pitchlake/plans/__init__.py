"""Builders of the warehouse tables and the graph that connects them."""
