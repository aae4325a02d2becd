"""Writers and storage reports."""
