"""Jobs: compositions of the operators, from messages to facts, dimensions and summaries."""
