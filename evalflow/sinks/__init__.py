"""Writers, finished-work checks and publishing."""
