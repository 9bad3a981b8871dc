"""Line-oriented jobs that run on batch and on streaming input alike."""
