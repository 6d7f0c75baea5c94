"""Raw inputs: sliced JSON logs, CSV feeds, reputation reports."""
