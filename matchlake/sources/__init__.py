"""Reading landed and stored tables, and writing them."""
