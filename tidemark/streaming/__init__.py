"""Running streams: checkpoints, triggers, and where their files may live."""
