"""Reading, decoding and reshaping logs."""
