"""Where the frames come from and where results go."""
