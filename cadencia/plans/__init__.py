"""Jobs: table maintenance, guarded rebuilds, audits and the composite pipelines. These run actions."""
