"""Training-data operators over whole document tables; nothing else in the library imports them."""
