"""Training-corpus operators: each module is one operator, ``queries`` registers them."""
