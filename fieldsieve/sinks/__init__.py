"""Writers: dumps, merged files, JSON lines, token shards, manifests and rejected rows."""
