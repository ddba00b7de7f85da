"""Training-data operators: one module per operator, one `queries` module that registers them."""
