"""Table-level operators: lazy DataFrame in, lazy DataFrame out."""
