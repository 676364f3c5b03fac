"""Table operators: relational, ordered, time-decayed, snapshot, request outcome."""
