"""Tables in, marts out."""
