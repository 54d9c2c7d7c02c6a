"""Query plans that make up a warehouse load."""
