"""Analysis operators, one module per subject. Every operator takes and returns DataFrames."""
