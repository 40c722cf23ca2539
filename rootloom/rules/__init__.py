"""Rule packs (word lists, patterns, label maps) used by the jobs as plain values."""
