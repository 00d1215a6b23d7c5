"""Stream-and-table correlation and geo-matching as plain DataFrame functions."""
