"""Writers: full-replace tables, keyed upsert, model export, run summary."""
