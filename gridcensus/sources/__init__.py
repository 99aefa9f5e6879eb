"""Readers and writers: snapshots, meshes, fields, manifests, partitioned tables."""
