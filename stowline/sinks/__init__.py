"""Writers: segment objects and latency logs."""
