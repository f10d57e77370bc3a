"""Jobs with a command line and a small configuration; each does its work in a function that takes a session."""
