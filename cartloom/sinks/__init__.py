"""Writers: slice files, day files, gated publish, manifest, day markers."""
