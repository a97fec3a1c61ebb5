"""The engine over the supplied tables: inputs shaped like trips and station events, one query per
operator or mart, and an equivalent SQL text for each."""
