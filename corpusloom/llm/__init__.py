"""Training-data operators: ten large-corpus steps and their registered queries."""
