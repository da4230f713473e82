"""Physical-strategy helpers: skew-safe segmented scans and checked broadcasts."""
