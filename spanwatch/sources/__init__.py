"""Raw documents in, weekly tables in and out."""
