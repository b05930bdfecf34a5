"""Pipeline operators: normalisers, staging, marts, serving, quality, upsert, incremental."""
