"""Training-data operators: ten large-corpus components that the matching engine itself never imports."""
