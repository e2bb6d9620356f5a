"""Readers and writers: files, message envelopes, layered tables, external stores."""
