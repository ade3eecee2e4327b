"""Jobs that chain readers, operators and writers for one date or a range of dates."""
